"""HTML extraction: the best contiguous region by a maximum-scoring subsequence over words and tags.

A page is a sequence of text runs and tags. Words score positive, tags negative, by prices that grow with the
log-odds of such tags outside the main text of the labelled pages below; a linear scan finds the contiguous stretch with the largest
sum, so lists of links, teasers and forms around the main text cost more than their few words bring and are left out.
What a run scores also depends on where it stands: every element around it, and every word of those elements' class, id
and role, has a log-odds weight of being around main text, learned from the same pages; so has standing outside article
or main on a page that has one. Where the weights sum to clearly less than zero the run is boilerplate: it scores nothing and is
left out even inside the region (an advert between two paragraphs); where they say main text, tags cost next to nothing.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CREDIT = 1.0
#: Price of a tag whose surroundings are those of main text.
WITHIN = 0.001
#: Price in words of a tag for each unit of its log-odds of standing outside main text; every tag costs BASE at least.
PRICE, BASE = 1.8, 0.02
#: Sums of weights down to minus this don't make boilerplate.
DOUBT = 0.5

# Labelled pages. What stands between [[ and ]] is main text.
LABELLED = [
    '<html><head><title>One</title><style>p{}</style><script>var a;</script></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav><div class="ad">Buy one now cheap</div><article>[[<h1>A day at sea</h1><p>We left the harbour early and the wind was kind.</p><p>By noon the land was gone.</p>]]</article><footer>Copyright by us</footer></body></html>',
    '<body><header class="site-header"><a href="/">The Paper</a><form action="/s"><input><button>Search</button></form></header><main>[[<h1>Rain again</h1><p>The river rose in the night and the bridge was closed.</p>]]<aside class="sidebar"><h3>Popular</h3><ul><li><a>Ten things</a></li></ul></aside>[[<p>It will open again on Friday.</p>]]</main><footer><p>Terms and privacy</p></footer></body>',
    '<body><div id="menu"><a>Start</a><a>News</a></div><div class="content">[[<h2>On bread</h2><p>Flour, water, salt and time are all it takes.</p><ul><li>Mix in the evening</li><li>Bake in the morning</li></ul>]]</div><div class="comments"><p>Great recipe, thank you!</p><p>Mine was too salty.</p></div><div class="footer">All rights reserved</div></body>',
    '<body><div class="cookie-notice"><p>We use cookies to improve your visit.</p><button>Accept</button></div><article class="post">[[<h1>Notes</h1><p>Short notes on a long book that I could not put down.</p>]]<div class="advertisement">Sponsored offer of the week</div>[[<blockquote>Call me what you like.</blockquote><p>The end is the best part.</p>]]<section class="comments" id="comments"><h3>Comments</h3><p>I liked it too.</p></section></article></body>',
    '<body><div class="navbar navigation"><ul><li>World</li><li>Sport</li></ul></div><div role="main" class="article-body">[[<h1>Cup final</h1><p>Two late goals settled a match that nobody will remember for its football.</p><table><tr><td>Goals</td><td>2</td></tr></table>]]</div><div class="related"><h4>Related stories</h4><a>Old final</a></div><div class="share social">Share this</div></body>',
    '<body><div class="banner promo">Save half today</div><section class="entry-content">[[<p>The museum shows forty paintings, most of them small, all of them blue.</p><p>Go before spring.</p>]]</section><div class="newsletter subscribe"><form><label>Your mail</label><input></form></div><div class="login popup modal">Sign in to read</div><div class="breadcrumb">Home / Art</div></body>',
    '<body><header><h1>City site</h1><nav><a>Offices</a></nav></header><article>[[<h2>New trams</h2><p>Ten trams were bought and eight of them run.</p>]]<form><label>Tell us</label><textarea>what you think</textarea></form><aside>More on trams</aside><footer>By the editor</footer></article><footer>Contact</footer></body>',
    '<body><div class="alert notice">The site is down on Sunday.</div><div class="text">[[<p>Old wells were dug by hand, and some are older than the church.</p>]]<figure class="sponsor"><p>Brought to you by a firm</p></figure></div><div class="widget tags">well, water</div><div class="pagination">1 2 3</div><div class="replies comment-list"><div class="comment">Nice one</div></div></body>',
    '<body>[[<h1>Plain</h1><p>Some pages have nothing but text in them.</p><p>They are the easy ones.</p><pre>and code</pre>]]</body>',
    '<body><div class="ads">Cheap shoes</div><div class="main">[[<h1>Hills</h1><p>Three hills stand north of here.</p><p>The middle one is the highest.</p>]]<div class="toolbar share">Print or send</div></div><div class="sidebar"><p>About the author</p></div><div class="disclaimer notices">No liability is taken</div></body>',
    '<body><nav class="menu"><a>One</a></nav><article>[[<h1>Fog</h1><p>Fog came in over the wall.</p>]]<div class="ad">Lamps on sale</div>[[<p>It left at ten.</p>]]<div class="discussion"><p>First comment here</p></div></article><aside class="recommended">You may like this</aside></body>',
    '<body><div role="banner">The site</div><div role="navigation"><a>Map</a></div><div role="complementary">Weather</div><div id="main-content" class="story">[[<h1>Snow</h1><p>It snowed on the pass and the post came late by a day.</p>]]</div><section id="respond" class="reply"><h3>Leave a reply</h3><p>Name and mail</p></section><div role="contentinfo">Imprint</div></body>',
    '<body><menu><li>Cut</li><li>Paste</li></menu><dialog open><p>Join our list today</p></dialog><search><p>Find a word</p></search><div class="copyright">All rights</div>[[<h2>Ink</h2><p>Ink was made from soot and gum, and kept in horns.</p>]]<div class="feedback">Was this of use?</div><div class="skip hidden">Skip to text</div></body>',
    '<body class="home page"><div id="site" class="site list wrapper container layout"><div class="tags list">wind, sea</div>[[<h1>Kites</h1><p>A kite needs wind, string and a field without trees in it.</p><p>On the coast there is always wind, and the fields are wide.</p>]]<div class="footer">Printed here</div></div></body>',
    '<body><div id="site" class="site"><div class="list view">[[<p>Bees find their way home by the sun, and on cloudy days by landmarks that they learned before.</p>]]</div><div class="popup">Stay with us</div></div></body>',
    '<body><nav><a>Start</a></nav>[[<div><h1>The mills of the north and their keepers</h1></div><div><section><h3>Wind</h3><p>The mill on the dyke still turns, and <a>its sails</a> are new.</p></section><section><h3>Water</h3><div><a><img></a><a><img></a></div><div><div>The old wheel stands in the brook.</div></div></section></div><ul><li><a>Maps of all the paths between them</a></li><li><a>Hours at which the mills are open</a></li></ul>]]<footer>Imprint</footer></body>',
    '<body><header><a>The Post</a></header>[[<div><div><h2>More ferries for the sound next year</h2></div><section><div><p>Two ferries cross the sound each hour, as <a>the new plan</a> says.</p></div><h4>Fares</h4><div><div><a><img></a></div><div><a><img></a></div></div><div><section><h3>Boats</h3><p>Both boats are white, and both were built here.</p></section></div></section></div>]]<div class="footer">Terms</div></body>',
    '<body><div><ul><li><a>Front page</a></li><li><a>Weather</a></li><li><a>Sport</a></li></ul></div><div>[[<h1>The orchard in winter and what is done there</h1><p>Old trees are cut back in the cold months, and <a>young ones</a> are tied to their stakes.</p><p>By March the work is done.</p>]]</div><div><ul><li><a>Read about bees</a></li><li><a>All stories</a></li></ul></div></body>',
    '<body><div><a>Log in</a><a>Help</a><a>Search</a></div><table><tr><td><a>Home</a></td><td><a>Shop</a></td></tr></table>[[<h2>On rope and the making of it</h2><p>Hemp was combed, spun and laid in long low sheds by the water.</p><p>A good rope took a day and four men.</p>]]<ol class="commentlist"><li>My father made rope</li></ol><div class="commentform">Write one</div><div><a>Older</a><a>Newer</a></div></body>',
    '<body><p><a>Contents</a> <a>Index</a></p>[[<h1>Salt pans of the lower coast</h1><p>Sea water stands in the pans until the sun has taken it.</p><ul><li>The first pan is the deepest and holds the water for a week</li><li>The last one is raked by hand at sunrise</li></ul><p>What is left is salt.</p>]]<p><a>Back</a></p><p><a>Print</a> <a>Mail</a></p></body>',
    '<body><div><a>Up</a></div>[[<h1>The winds of the bay and their seasons</h1><p>Four winds blow here, and each has its months.</p><table><tr><td>North</td><td>cold and dry</td></tr><tr><td>South</td><td>warm, with rain</td></tr><tr><td>West</td><td>all through spring</td></tr></table><p>The east wind is the rarest of them.</p>]]<div><a>Down</a></div></body>',
]

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|select|object|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?:/?[a-zA-Z]|[!?/])[^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?")
_TELLING = frozenset({"class", "id", "role"})
_ROLE_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: Elements that say nothing about what stands in them.
_NEUTRAL = _INLINE | frozenset("html body p br div section h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th blockquote pre figure figcaption".split()) - {"label"}
#: The feature of standing outside article or main on a page that has one.
OUTSIDE = "outside"
#: Price of a tag that no labelled page has.
UNSEEN = 0.1


def _features(name: str, attrs: str) -> list[str]:
    out = [] if name in _NEUTRAL else [name]
    if "=" in attrs and name not in ("html", "body"):
        for key, *values in _ATTRIBUTE.findall(attrs):
            if key.lower() in _TELLING:
                out += ["." + w.lower() for w in _ROLE_WORD.findall("".join(values))]
    return out


class Surroundings:
    """The open elements at one place of a page: their names, and how often each of their features is around."""

    def __init__(self):
        self.stack: list[tuple[str, list[str]]] = []
        self.names: Counter[str] = Counter()
        self.features: Counter[str] = Counter()

    def opened(self, name: str, features: list[str]) -> None:
        self.stack.append((name, features))
        self.names[name] += 1
        self.features.update(features)

    def closed(self) -> str:
        name, features = self.stack.pop()
        self.names[name] -= 1
        for f in features:
            self.features[f] -= 1
            if not self.features[f]:
                del self.features[f]
        return name

    @property
    def inside(self) -> str:
        return self.stack[-1][0] if self.stack else ""


def runs(page: str, around: Surroundings):
    """(kind, text or tag) for each text run and tag of a page, in order, while ``around`` follows; a tag stands in its element.

    Each element is opened and closed once, so a page takes time in proportion to its length however deep it nests.
    """
    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            yield "text", page[at : token.start()]
        at = token.end()
        name = token["name"]
        if name is None:
            yield "drop", token["raw"] or ""
            continue
        name = name.lower()
        if token["end"]:
            found = around.names[name] > 0
            while found and around.inside != name:
                around.closed()
            yield "tag", name
            if found:
                around.closed()
            continue
        if name == around.inside and name in ("p", "li"):
            around.closed()
        around.opened(name, _features(name, token["attrs"]))
        yield "tag", name
        if name in _VOID or token["attrs"].rstrip().endswith("/"):
            around.closed()
    if at < len(page):
        yield "text", page[at:]


def _has_whole(page: str) -> bool:
    """Whether the page has an element that holds the whole main text, among its tags as they are read."""
    around = Surroundings()
    return any(kind == "tag" and _within(around) for kind, _ in runs(page, around))


def _within(around: Surroundings) -> bool:
    return bool(around.features["article"] or around.features["main"] or around.features[".main"])


def _labelled(pages: list[str]):
    """(in main text, kind, text or tag, surroundings, outside article or main) for each run and tag of labelled pages."""
    for page in pages:
        inside, around, has = False, Surroundings(), _has_whole(page)
        for kind, value in runs(page, around):
            for piece in re.split(r"(\[\[|\]\])", value):
                if piece in ("[[", "]]"):
                    inside = piece == "[["
                elif piece:
                    yield inside, kind, piece, around, has and not _within(around)


class Weights:
    """Log-odds of features around main words against other words, and the price of each tag, from labelled pages."""

    def __init__(self, pages: list[str]):
        main, other, tag_main, tag_other = Counter(), Counter(), Counter(), Counter()
        for inside, kind, value, around, outside in _labelled(pages):
            if kind == "text" and (n := len(value.split())):
                (main if inside else other).update(dict.fromkeys({*around.features, *([OUTSIDE] if outside else [])}, n) | {"": n})
        self.feature = {f: math.log((main[f] + 0.5) / (main[""] + 1)) - math.log((other[f] + 0.5) / (other[""] + 1)) for f in main.keys() | other.keys() if f}
        # prices count where nothing else tells, so that is where they are learned
        for inside, kind, value, around, outside in _labelled(pages):
            if kind == "tag" and -DOUBT < self.sum(around, outside) <= 0:
                (tag_main if inside else tag_other)[value] += 1
        n_main, n_other = tag_main.total() + 1, tag_other.total() + 1
        odds = {t: math.log((tag_other[t] + 0.5) / n_other) - math.log((tag_main[t] + 0.5) / n_main) for t in tag_main.keys() | tag_other.keys()}
        self.tag = {t: BASE + PRICE * max(0.0, x) for t, x in odds.items()}

    def sum(self, around: Surroundings, outside: bool) -> float:
        """What is for main text counts up to CREDIT in all, so that no wrapper outweighs a sign of boilerplate in it."""
        known = [self.feature.get(f, 0.0) for f in around.features]
        if outside:
            known.append(self.feature.get(OUTSIDE, 0.0))
        return min(CREDIT, sum(w for w in known if w > 0)) + sum(w for w in known if w < 0)


def scored(page: str, weights: Weights) -> list[tuple[float, str]]:
    """(score, text) of each run and tag; boilerplate scores nothing and has no text."""
    has, around = _has_whole(page), Surroundings()
    items: list[tuple[float, str]] = []
    for kind, value in runs(page, around):
        if kind == "drop":
            items.append((0.0, " " if value else ""))
            continue
        weight = weights.sum(around, has and not _within(around))
        if kind == "text":
            text = entities.unescape(value) if "&" in value else value
            items.append((float(len(text.split())), text) if weight > -DOUBT else (0.0, ""))
        else:
            price = 0.0 if weight <= -DOUBT else WITHIN if weight > 0 else weights.tag.get(value, UNSEEN)
            items.append((-price, "" if value in _INLINE else " "))
    return items


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch with the largest sum, the first of equals; empty if none is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, span = total, (start, i + 1)
    return span


def extract(page: str, weights: Weights) -> str:
    """The main text of a page, its blocks joined by one space, references decoded, white space made one space."""
    items = scored(page, weights)
    start, end = best_stretch([score for score, _ in items])
    return " ".join("".join(text for _, text in items[start:end]).split())


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", labelled: list[str] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``; ``labelled`` are pages with main text in [[ and ]].

    A null or empty page, or one without main words, has the empty text. Whole pages are read, unclosed markup to their
    end. Repeated rows come out repeated; other columns are ignored; an empty table gives no rows.
    """
    weights = Weights(labelled or LABELLED)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches):
        for batch in batches:
            texts = [extract(page or "", weights) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = dict(rows.dtypes)
    out = rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": page_id, "url": url})
