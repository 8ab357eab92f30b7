"""Document fingerprints by winnowing, in DataFrame operations.

The units of every text are its code points. Every GRAM consecutive units have a hash, every WINDOW consecutive hashes
give their least one, the rightmost of equals, and the fingerprint is the set of those with their positions. So any run
of GRAM + WINDOW - 1 characters that two texts share, however their lengths differ, puts a common hash into both
fingerprints, and the positions say where. Grams of eight characters are long enough that unrelated long texts of a
language share few of them, and short enough for texts of a few words.

A picked gram is one long: 33 bits of hash, 30 bits of position; while minima are taken the position is inverted, so
that the least value is the least hash and among equals the rightmost.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandflow.llm.common import quoted

#: The window is a power of two, as minima are made by doubling.
GRAM, WINDOW = 8, 8
_POSITION = (1 << 30) - 1
#: Code points whose grams are cut from one string: finding a place in a string takes as many steps as lie before it.
STRETCH = 32
#: Units before an edit from which on windows are looked at again: those that begin earlier pick nothing later.
REACH = GRAM + 2 * WINDOW - 2
#: Quantiles of doc_id that part the table, and bytes of text that a part holds about.
QUANTILES, PART_BYTES = 256, 8 << 20
#: Bytes of text that a task gets about, at most.
TASK_BYTES = 64 << 20
#: Ids with the least hashes that the quantiles of ids other than whole numbers are taken from.
SAMPLE = 4096
_LONG = "array<long>"
_NO_ID = -(1 << 63)


def winnowed(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the picked grams of column ``text`` (no null), as longs, each once, in order of position.

    Each step is a projection of its own whose input is used more than once, so that Spark doesn't compute it again for
    every use.
    """
    kept, found, count, grams = df.columns, f"{out}_found", f"{out}_n", f"{out}_grams"
    # stretches of STRETCH code points, each with a look ahead at the grams that run past its end
    pattern = f"(?s)(?=(.{{1,{STRETCH + GRAM - 1}}})).{{1,{STRETCH}}}"
    df = df.select(*kept, F.regexp_extract_all(F.col(text), F.lit(pattern)).alias(found))
    packed = lambda g, i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(g), 31), 30).bitwiseOR((F.lit(_POSITION) - i).cast("long"))
    places = lambda c: F.slice(F.lit(list(range(STRETCH))), 1, F.greatest(F.length(c) - (GRAM - 1), F.lit(0)))
    each = F.flatten(F.transform(found, lambda c, k: F.transform(places(c), lambda j: packed(F.substring(c, j + 1, F.lit(GRAM)), k * STRETCH + j))))
    short = F.when(F.length(text) > 0, F.array(packed(F.col(text), F.lit(0)))).otherwise(F.array().cast(_LONG))
    df = df.select(*kept, F.when(F.length(text) < GRAM, short).otherwise(each).alias(grams))
    df = df.select(*kept, grams, F.size(grams).alias(count))
    least, width = grams, 1
    while width < WINDOW:  # the least of twice as many, from two that lie side by side; past the end there is none
        rest = F.slice(F.col(least), width + 1, F.greatest(F.size(least) - width, F.lit(0)))
        wider = f"{out}_least{2 * width}"
        df = df.select(*kept, count, F.zip_with(F.col(least), rest, lambda a, b: F.least(a, b)).alias(wider))
        least, width = wider, 2 * width
    picked = F.array_distinct(F.slice(least, 1, F.greatest(F.col(count) - WINDOW + 1, F.lit(1))))
    return df.select(*kept, picked.alias(out))


def as_text(picked: str) -> Column:
    """The picked grams as 16 hex digits each: a bit that is 1, 33 bits of hash, 30 bits of position."""
    return F.lower(F.array_join(F.transform(picked, lambda v: F.hex(v.bitwiseXOR(F.lit(_POSITION)).bitwiseOR(F.lit(-(1 << 63))))), " "))


def hash_set(picked: str) -> Column:
    return F.array_distinct(F.transform(picked, lambda v: F.shiftright(v, 30)))


def likeness(a: str, b: str, common: str) -> Column:
    """Common over all hashes of two hash sets; 1 if neither has any."""
    every = F.size(a) + F.size(b) - F.col(common)
    return F.when(every == 0, F.lit(1.0)).otherwise(F.col(common) / every)


def _between(col: Column, edges: list, before: int = 0) -> Column:
    """``before`` plus the number of ``edges`` that are no larger, by halving; 0 for a null."""
    if not edges:
        return F.lit(before)
    half = len(edges) // 2
    return F.when(col >= F.lit(edges[half]), _between(col, edges[half + 1 :], before + half + 1)).otherwise(_between(col, edges[:half], before))


def in_parts(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """(id, text, h, part), and the bytes of all texts, where the rows of a part come before those of larger parts by id, hash of the text and text.

    The parts are ranges between approximate quantiles of the ids (upper 32 bits), each divided again (lower 32): an id
    that several quantiles fall on (a third of all rows without an id, say) by the hash h of its texts, the other ids
    evenly for large tables. The driver sees QUANTILES numbers whatever the size. Ids that aren't whole numbers are
    parted between quantiles of a sample, without a further division.
    """
    body = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(quoted(doc_id).alias("id"), body.alias("text"), F.shiftrightunsigned(F.xxhash64(body), 33).alias("h"))
    size = F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")
    if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        drawn = rows.select("id").where(F.col("id").isNotNull()).orderBy(F.xxhash64("id")).limit(SAMPLE).collect()
        ids = sorted({r.id for r in drawn})
        return rows.withColumn("part", F.shiftleft(_between(F.col("id"), ids[:: max(1, len(ids) // QUANTILES)][1:]).cast("long"), 32)), rows.agg(size).first()["bytes"]
    number = F.coalesce(F.col("id").cast("long"), F.lit(_NO_ID))
    asked = [k / QUANTILES for k in range(1, QUANTILES)]
    seen = rows.agg(size, F.percentile_approx(number, asked, 10_000).alias("q")).first()
    often = Counter(seen["q"] or [])
    edges = sorted(often)
    bounds = F.lit(edges) if edges else F.array().cast(_LONG)
    q = F.size(F.filter(bounds, lambda e: e <= number))
    even = max(1, math.ceil(seen["bytes"] / PART_BYTES / (len(edges) + 1)))
    low, high = F.get(bounds, q - 1).cast("double"), F.get(bounds, q).cast("double")
    inner = F.least(F.lit(even - 1), F.floor((number.cast("double") - low) / (high - low) * even))
    inner = F.coalesce(F.greatest(F.lit(0), inner), F.lit(0)) if even > 1 and len(edges) > 1 else F.lit(0)
    hot = {e: even * (n + 1) for e, n in often.items() if n > 1}
    if hot:
        cuts = F.coalesce(F.get(F.lit([hot.get(e, 0) for e in edges]), q - 1), F.lit(0))
        share = F.col("h").cast("double") / float(1 << 31)
        inner = F.when((cuts > 0) & (number == F.get(bounds, q - 1)), F.floor(share * cuts)).otherwise(cuts + inner)
    return rows.withColumn("part", F.shiftleft(q.cast("long"), 32) + inner), seen["bytes"]


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, picked, own, next_text, next_own) where next is the row of the next id, after the last the first.

    ``picked`` are the picked grams of the text, ``own`` is the set of their hashes. Texts are shuffled once; the first
    row of each part goes to the part before it. Rows of equal ids follow one another by a hash of the text, and the text.
    """
    rows, total = in_parts(docs, doc_id, text)
    tasks = math.ceil(total / TASK_BYTES)  # a task has a bounded share of the texts, however few the session asks for
    dealt = rows.repartition("part") if tasks <= int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows.repartition(tasks, "part")
    order = Window.partitionBy("part").orderBy("id", "h", "text")  # of columns as they are, so that one sort serves all uses
    first = dealt.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("part", "text")
    first = winnowed(first, "text", "picked").select("part", F.col("text").alias("first_text"), hash_set("picked").alias("first_own"))

    parts = rows.select("part").distinct().withColumn("q", F.shiftright("part", 32))
    of_q = parts.groupBy("q").agg(F.max("part").alias("most"))
    before = F.coalesce(F.lag("most").over(Window.orderBy("q")), F.max("most").over(Window.partitionBy()))  # over at most QUANTILES rows
    of_q = of_q.select(F.col("q").alias("of"), before.alias("before"))
    steps = parts.withColumn("inside", F.lag("part").over(Window.partitionBy("q").orderBy("part")))
    steps = steps.join(F.broadcast(of_q), F.col("q") == F.col("of")).select("part", F.coalesce("inside", "before").alias("to"))
    ahead = first.join(steps, "part").select(F.col("to").alias("part"), "first_text", "first_own")

    own = winnowed(dealt, "text", "picked").withColumn("own", hash_set("picked"))
    nexts = own.withColumn("lead_text", F.lead("text").over(order)).withColumn("lead_own", F.lead("own").over(order))
    joined = nexts.join(ahead, "part")
    return joined.select("id", "text", "picked", "own", F.coalesce("lead_text", "first_text").alias("next_text"), F.coalesce("lead_own", "first_own").alias("next_own"))


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited, picked, edited_picked, near_edited, near_next) for each row of ``docs``.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many, or all, of the next
    document's. Likeness is the share of hashes that two fingerprints have in common. A null text is empty; an empty
    text has no grams, a text of fewer than GRAM characters one of all of them, and two empty fingerprints are alike. A
    single document is its own next. Equal texts have equal fingerprints; an empty table gives no rows; a null doc_id
    comes first; ids of any type that can be sorted will do; repeated rows come out repeated; other columns are ignored.
    """
    rows = with_next(docs, doc_id, text).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("stay", F.col("n_chars").cast("int") - cut)
    edited = F.concat(F.substring("text", F.lit(1), F.col("stay")), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("id", "n_chars", "stay", "picked", "own", "next_own", edited.alias("edited"))

    # Windows before the edit pick what they did: only from REACH before it on is picked again.
    rows = rows.withColumn("again", F.greatest(F.lit(0), F.col("stay") - REACH))
    rows = rows.withColumn("tail", F.substring(F.col("edited"), F.col("again") + 1, F.length("edited")))
    rows = winnowed(rows, "tail", "tail_picked").drop("tail")
    place = lambda v: F.lit(_POSITION) - v.bitwiseAND(F.lit(_POSITION))
    before = F.filter("picked", lambda v: place(v) <= F.col("stay") - (GRAM + WINDOW - 1))
    after = F.transform("tail_picked", lambda v: v - F.col("again"))
    anew = F.when(F.col("again") > 0, F.array_distinct(F.concat(before, after))).otherwise(F.col("tail_picked"))
    rows = rows.withColumn("edited_picked", anew).withColumn("edited_own", hash_set("edited_picked"))
    rows = rows.withColumns({f"common_{x}": F.size(F.array_intersect("own", f"{x}_own")) for x in ("edited", "next")})
    return rows.select(
        F.col("id").alias(doc_id), "n_chars", "edited", "picked", "edited_picked",
        likeness("own", "edited_own", "common_edited").alias("near_edited"), likeness("own", "next_own", "common_next").alias("near_next"),
    )
