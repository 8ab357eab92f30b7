"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

1. Windows. A window of an item's length can only reach the similarity if shingles of items of that length weigh in it
   at least SIMILARITY times as much as the lightest of those items. Every window that does is opened, whatever item the
   shingles come from and in whatever order they stand: which item a window is like, the fingerprints say.
2. Windows and items get 64-bit SimHashes of their weighted shingles. Each item is entered in BLOCKS tables under every
   value within RADIUS // BLOCKS bits of its own block; each window looks up its blocks. Of two fingerprints within
   RADIUS bits, one block differs in no more than that, so the tables miss none; the rest are told by full distance.
3. Candidates are verified by the exact weighted similarity of their shingles.

All of it is DataFrame operations; a shingle's weight is its number of characters. Texts are read once and never
shuffled: where a shingle is met, the words around it go along, once for each stretch of a text.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandflow.llm.common import checkpointed, fresh, quoted

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, RADIUS = 4, 23
_BITS = 64 // BLOCKS
#: Item shingles (about 40 MB) that are sent to all executors at once: a larger benchmark is searched for in slices of
#: whole items. Also the rows without a text up to which a table is broadcast.
BROADCAST_ROWS = 1_000_000
#: Rows that one fingerprint's windows are dealt to.
SALTS = 16
#: What parts words: anything but letters and digits.
SEPARATOR = r"[^\p{L}\p{N}]+"


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(quoted(text), F.lit(""))), SEPARATOR), lambda w: w != "")


def _starts(n: Column) -> Column:
    """Places of the shingles of ``n`` words: the whole sequence is the only one if it is short, and none has none."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def shingles(seq: str) -> Column:
    """The distinct shingles of a column of words, as text."""
    return F.array_distinct(F.transform(_starts(F.size(seq)), lambda i: F.array_join(F.slice(F.col(seq), i + 1, SHINGLE), " ")))


def _runs(size: int) -> Column:
    """A hash of each run of ``size`` words of the word hashes ``wh``, in order, for the search only."""
    last = F.size("wh") - size
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(F.col("wh"), i + k) for k in range(size)]))


def simhash(parts: str) -> Column:
    """SimHash of a column of shingles: a bit is 1 if the shingles that have it weigh over half."""
    pairs = F.transform(F.col(parts), lambda p: F.struct(F.xxhash64(p).alias("h"), F.length(p).alias("w")))
    zero = F.array_repeat(F.lit(0), 64)
    sums = F.aggregate(pairs, zero, lambda acc, p: F.transform(acc, lambda x, b: x + F.when(F.getbit(p["h"], b) == 1, p["w"]).otherwise(-p["w"])))
    return F.aggregate(F.transform(sums, lambda x, b: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _block(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, k * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1))


def _blocks(fp: str) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("t"), _block(F.col(fp), k).alias("v")) for k in range(BLOCKS)])


def _weight(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + F.length(p))


def items_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, length, parts): the shingles of each item that has any word."""
    rows = benchmark.select(quoted(item_id).alias("item"), words(text).alias("seq")).where(F.size("seq") > 0)
    return rows.select("item", F.size("seq").alias("length"), shingles("seq").alias("parts"))


def _hash_of(part: Column) -> Column:
    """What ``_runs`` gives for a shingle: by its number of words, SHINGLE at most."""
    return reduce(lambda other, n: F.when(F.size(part) == n, F.xxhash64(*[F.xxhash64(F.get(part, F.lit(k))) for k in range(n)])).otherwise(other), range(1, SHINGLE + 1), F.lit(None).cast("long"))


def windows(docs: DataFrame, items: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, start, length, body): the windows of ``docs`` that weigh enough in shingles of items of their length."""
    facts = items.agg(F.max("length").alias("most"), F.collect_set(F.least("length", F.lit(SHINGLE))).alias("sizes")).first()
    most, sizes = facts["most"] or 1, sorted(facts["sizes"]) or [SHINGLE]
    least = items.groupBy("length").agg((F.min(_weight(F.col("parts"))) * SIMILARITY - 1e-6).alias("need"))
    own = items.select("length", F.explode("parts").alias("p")).select("length", _hash_of(F.split("p", " ")).alias("h"), F.length("p").alias("w")).distinct()
    own = checkpointed(own.join(least, "length"))
    if own.count() <= 2 * BROADCAST_ROWS:  # more only if a single item has so many
        own = F.broadcast(own)

    seq = docs.select(quoted(doc_id).alias("id"), F.xxhash64(quoted(text)).alias("same"), words(text).alias("seq"))
    hashed = seq.select(F.struct("id", "same").alias("doc"), "seq", F.transform("seq", lambda w: F.xxhash64(w)).alias("wh"))
    # The runs are a column of their own: taken apart in generated code, rows that meet nothing never copy their words.
    # The outer form keeps Spark from inferring a filter on them, which would hash the words anew for every run.
    met = [hashed.select("doc", "seq", _runs(r).alias("runs")).select("doc", "seq", F.posexplode_outer("runs").alias("at", "h")).join(own.where(F.least("length", F.lit(SHINGLE)) == r), "h") for r in sizes]
    met = reduce(DataFrame.unionAll, met).withColumn("n", F.size("seq"))
    # Windows that begin in one stretch of ``most`` words lie in it and the next: those words go along, and the place
    # goes to every stretch in which a window that holds it may begin.
    reach = F.col("length") - F.least("length", F.lit(SHINGLE))
    low, high = F.greatest(F.lit(0), F.col("at") - reach), F.least(F.col("at"), F.greatest(F.lit(0), F.col("n") - F.col("length")))
    stretch = F.explode(F.array_distinct(F.array(F.floor(low / most).cast("int"), F.floor(high / most).cast("int")))).alias("stretch")
    place = F.struct("length", "need", "at", "w").alias("place")
    spread = met.select("doc", "seq", "n", place, stretch)
    near = F.slice("seq", F.col("stretch") * most + 1, F.lit(2 * most))
    rows = spread.groupBy("doc", "n", "stretch").agg(F.first(near).alias("near"), F.collect_set("place").alias("places"))

    kinds = F.array_distinct(F.transform("places", lambda p: F.struct(p["length"].alias("length"), p["need"].alias("need"))))
    rows = rows.select("doc", "n", "stretch", "near", "places", F.explode(kinds).alias("k")).select("doc", "n", "stretch", "near", "k.length", "k.need", F.filter("places", lambda p: p["length"] == F.col("k.length")).alias("mine"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, p: s + p["w"])
    rows = rows.where(total(F.col("mine")) >= F.col("need"))
    first, last = F.col("stretch") * most, F.least((F.col("stretch") + 1) * most - 1, F.greatest(F.lit(0), F.col("n") - F.col("length")))
    reach = F.col("length") - F.least("length", F.lit(SHINGLE))
    starts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    heavy = F.filter(starts, lambda s: total(F.filter("mine", lambda p: p["at"].between(s, s + reach))) >= F.col("need"))
    rows = rows.select("doc", "stretch", "near", "length", F.explode(heavy).alias("start"))
    body = F.array_join(F.slice("near", F.col("start") - F.col("stretch") * most + 1, F.col("length")), " ")
    return rows.select(F.col("doc.id").alias("doc"), "start", F.least("length", F.size("near")).alias("length"), body.alias("body"))


def _matches(docs: DataFrame, items: DataFrame, doc_id: str, text: str, small: bool) -> DataFrame:
    """The most similar window of each document and item, for items that are searched for together."""
    cut = windows(docs, items, doc_id, text).withColumn("seq", F.split("body", " ")).withColumn("parts", shingles("seq"))
    cut = checkpointed(cut.select("doc", "start", F.size("seq").alias("length"), "parts", simhash("parts").alias("fp")))
    prints = cut.select("fp").distinct()  # copies of a passage are searched once
    probes = prints.select("fp", F.explode(_blocks("fp")).alias("p")).select("fp", "p.t", "p.v")

    near = [sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in itertools.combinations(range(_BITS), r)]
    tables = items.select("item", F.col("parts").alias("item_parts"), simhash("parts").alias("item_fp"))
    entered = tables.select("item", "item_fp", F.explode(_blocks("item_fp")).alias("e")).select("item", "item_fp", "e.t", "e.v", F.explode(F.lit(near)).alias("flip"))
    entered = entered.select("item", "item_fp", "t", F.col("v").bitwiseXOR(F.col("flip")).alias("v"))

    hamming = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    found = probes.join(entered.hint("merge"), ["t", "v"])  # thousands of rows an item: not to be broadcast
    found = found.where(hamming <= RADIUS).select("fp", "item", hamming.alias("hamming")).distinct()
    # A passage that a third of all documents hold has one fingerprint: its windows are dealt to SALTS rows of ``found``.
    salt = F.pmod(F.xxhash64("doc", "start"), F.lit(SALTS)).cast("int")
    found = found.withColumn("salt", F.explode(F.lit(list(range(SALTS)))))
    pairs = cut.withColumn("salt", salt).join(found.hint("merge"), ["fp", "salt"])
    theirs = tables.select(F.col("item").alias("i"), "item_parts")
    pairs = pairs.join(F.broadcast(theirs) if small else theirs, F.col("item").eqNullSafe(F.col("i")))
    both = _weight(F.array_intersect("parts", "item_parts"))
    alike = (both / (_weight(F.col("parts")) + _weight(F.col("item_parts")) - both)).alias("similarity")
    alike = pairs.select("doc", "item", "start", "length", "hamming", alike).where(F.col("similarity") >= SIMILARITY)
    best = alike.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("before"), "length", "hamming")).alias("b"))
    return best.select("doc", "item", (-F.col("b.before")).cast("long").alias("start_word"), F.col("b.length").cast("long").alias("n_words"), F.col("b.hamming").cast("long").alias("hamming"), "b.similarity")


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): for each document and item the most similar window.

    Words are lower-cased runs of letters and digits; shingles have five words, or all words of a shorter item or window.
    A window has as many words as the item, or is the whole text if that is shorter; windows of every place count. Only
    similarities of SIMILARITY or more (weight of the common over that of all distinct shingles) are returned; of
    equals, the first window. Null, empty and wordless texts and items match nothing; an empty table gives no rows;
    rows that repeat an id are taken as one document (its best window); other columns are ignored. Windows to be opened
    grow with the square of an item's length, so items of many thousand words are best cut into parts.
    """
    items = checkpointed(items_of(benchmark, item_id, item_text))
    n = items.agg(F.sum(F.size("parts"))).first()[0] or 0
    slices, small = max(1, math.ceil(n / BROADCAST_ROWS)), n <= BROADCAST_ROWS // 4
    part = F.pmod(F.xxhash64("item"), F.lit(slices))
    found = reduce(DataFrame.unionAll, (_matches(docs, items.where(part == k) if slices > 1 else items, doc_id, text, small) for k in range(slices)))
    return found.withColumnsRenamed({"doc": doc_id, "item": item_id})


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text matches no item, with all their columns, whatever those are called.

    A row is known by its id and a hash of its text, so a match drops no other row without an id, or with the same one.
    """
    key, body, hit, same = fresh(docs, "key", "body", "hit", "same")
    keyed = docs.select(F.struct(quoted(doc_id).alias("id"), F.xxhash64(quoted(text)).alias("h")).alias(key), quoted(text).alias(body))
    found = checkpointed(matches(keyed, benchmark, key, body).select(F.col(f"{key}.id").alias(hit), F.col(f"{key}.h").alias(same)).distinct())
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    return docs.join(found, quoted(doc_id).eqNullSafe(F.col(hit)) & (F.xxhash64(quoted(text)) == F.col(same)), "left_anti")
