"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate that brings its characters to its weight's share of the output; a document's
number of copies is a Poisson variable with that mean, found by inverting its distribution at a uniform number that is
a hash of seed and id. So the copies of a document depend on nothing but the rates, whatever task or retry makes them.
Copies are then dealt to tasks and ordered by a hash of id and copy: a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandflow.llm.common import checkpointed, fresh, quoted

SEED = "mix-1"
#: Weights are the sources' sizes to this power unless they are given: between a uniform mix (0) and none (1).
TEMPERATURE = 0.5
#: A larger mean is drawn as the sum of independent parts of no more than this.
PART = 16.0
#: Terms of a part's distribution; the rest has a probability below 1e-20.
TERMS = 96
#: Sources up to which their rates are sent to all executors; beyond, the join is shuffled.
BROADCAST_ROWS = 100_000
#: Hex digits of a digest that make a uniform number, and the largest such number.
_DIGITS = 13
_LARGEST = 1 - 16.0**-_DIGITS
#: Mean number of copies from which a document's are made in pieces of so many, dealt to tasks before they are made.
PIECE = 512


def rates(docs: DataFrame, source: str = "source", text: str = "text", weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, size, rate) for each source: characters, and the mean number of copies.

    The output is to have as many characters as the input. ``weights`` (any positive scale; a source not named has 0)
    replaces the sizes to the power ``temperature``. A source without characters has rate 0.
    """
    sizes = docs.groupBy(quoted(source).alias("source")).agg(F.sum(F.coalesce(F.length(quoted(text)), F.lit(0)).cast("long")).alias("size"))
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        named = sizes.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()], "named string, weight double")
        sizes = sizes.join(named, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
        weight = F.coalesce("weight", F.lit(0.0))
    sizes = checkpointed(sizes.select("source", "size", weight.alias("weight")))
    total = sizes.where("size > 0").agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    if not total["weight"]:
        return sizes.select("source", "size", F.lit(0.0).alias("rate"))
    rate = F.when(F.col("size") > 0, F.col("weight") / F.lit(total["weight"]) * F.lit(float(total["size"])) / F.col("size")).otherwise(0.0)
    return sizes.select("source", "size", rate.alias("rate"))


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the digest of its parts as text."""
    key = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, _DIGITS), 16, 10).cast("double") / float(16**_DIGITS)


def cumulative(mean: Column) -> Column:
    """The cumulative probabilities of 0, 1, ... for a mean of at most PART, up to the first that no number exceeds."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("below"), F.array(first).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        more = F.struct(p.alias("p"), (acc["below"] + p).alias("below"), F.array_append(acc["all"], acc["below"] + p).alias("all"))
        return F.when(acc["below"] > _LARGEST, acc).otherwise(more)

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["all"])


def poisson(below: Column, u: Column) -> Column:
    """The least n whose cumulative probability, of the table ``below``, exceeds ``u``; TERMS if none does."""
    return F.least(F.size(F.filter(below, lambda c: c <= u)), F.lit(TERMS)).cast("long")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as its draw says, with ``copy`` (from 0) and ``shuffle_key``, in shuffled order.

    A null id or source takes part like any other value, a null text has size 0, and repeated rows have the draw of
    their id. An empty table gives no rows; all columns are kept, but columns named ``copy`` or ``shuffle_key`` replaced.
    """
    of, rate, parts, table, n, piece = fresh(docs, "of", "rate", "parts", "table", "n", "piece")
    known = rates(docs, source, text, weights, temperature).where("rate > 0").select(F.col("source").alias(of), F.col("rate").alias(rate))
    known = known.withColumn(parts, F.greatest(F.lit(1), F.ceil(F.col(rate) / PART).cast("int")))
    known = checkpointed(known.withColumn(table, cumulative(F.col(rate) / F.col(parts))))
    facts = known.agg(F.count("*").alias("n"), F.max(rate).alias("most")).first()
    if facts["n"] <= BROADCAST_ROWS:
        known = F.broadcast(known)
    own = docs.drop("copy", "shuffle_key").join(known, quoted(source).eqNullSafe(F.col(of))).drop(of)
    kept = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    draws = F.transform(F.sequence(F.lit(0), F.col(parts) - 1), lambda k: poisson(F.col(table), uniform(seed, quoted(doc_id), k)))
    drawn = own.select(*map(quoted, kept), rate, F.aggregate(draws, F.lit(0).cast("long"), lambda a, x: a + x).alias(n))
    # the outer form keeps Spark from drawing once more in a filter; documents without a copy leave no number behind
    numbers = lambda low, high: F.when(high >= low, F.sequence(low, high))
    some = drawn.where(F.col(rate) <= PIECE) if (facts["most"] or 0) > PIECE else drawn
    copies = some.select(*map(quoted, kept), F.explode_outer(numbers(F.lit(0).cast("long"), F.col(n) - 1)).alias("copy"))
    if (facts["most"] or 0) > PIECE:
        many = drawn.where(F.col(rate) > PIECE).select(*map(quoted, kept), n, F.explode_outer(numbers(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / PIECE))).alias(piece))
        many = many.where(F.col(piece).isNotNull()).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), quoted(doc_id), F.col(piece))
        low, high = F.col(piece) * PIECE, F.least((F.col(piece) + 1) * PIECE, F.col(n)) - 1
        copies = copies.unionAll(many.select(*map(quoted, kept), F.explode_outer(numbers(low, high)).alias("copy")))
    copies = copies.where(F.col("copy").isNotNull())
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.coalesce(quoted(doc_id).cast("string"), F.lit("")), F.col("copy").cast("string"))))
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parallel, "shuffle_key").sortWithinPartitions("shuffle_key")


#: DuckDB SQL for ``mix`` over the table documents with the default parameters.
SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, sum(coalesce(length(text), 0)) AS size FROM documents GROUP BY source),
weighted AS (SELECT source, size, power(CAST(size AS DOUBLE), {TEMPERATURE}) AS weight FROM sizes),
total AS (SELECT sum(size) AS all_size, sum(weight) AS all_weight FROM weighted WHERE size > 0),
rates AS (SELECT source, CASE WHEN size > 0 THEN weight / all_weight * CAST(all_size AS DOUBLE) / CAST(size AS DOUBLE) ELSE 0.0 END AS rate FROM weighted, total),
parts AS (SELECT source, rate, greatest(1, CAST(ceil(rate / {PART}) AS INTEGER)) AS parts FROM rates WHERE rate > 0),
terms AS (
  SELECT source, 0 AS n, exp(-rate / parts) AS p, exp(-rate / parts) AS below, rate / parts AS mean FROM parts
  UNION ALL SELECT source, n + 1, p * mean / (n + 1), below + p * mean / (n + 1), mean FROM terms WHERE n < {TERMS}),
lots AS (
  SELECT d.doc_id, d.source, k.k, CAST(CAST('0x' || substr(md5('{SEED}|' || d.doc_id || '|' || k.k), 1, {_DIGITS}) AS BIGINT) AS DOUBLE) / {16**_DIGITS}.0 AS u
  FROM documents d JOIN parts USING (source), LATERAL (SELECT unnest(range(parts.parts)) AS k) k),
counts AS (
  SELECT doc_id, sum(n) AS copies FROM (
    SELECT l.doc_id, l.k, least(min(t.n) FILTER (WHERE t.below > l.u), {TERMS}) AS n FROM lots l JOIN terms t USING (source) GROUP BY l.doc_id, l.k, l.u) GROUP BY doc_id)
SELECT d.doc_id, d.source, c.copy, md5('{SEED}|order|' || d.doc_id || '|' || c.copy) AS shuffle_key, d.n_chars, d.lang, d.text
FROM documents d JOIN counts USING (doc_id), LATERAL (SELECT CAST(unnest(range(CAST(counts.copies AS BIGINT))) AS BIGINT) AS copy) c
"""
