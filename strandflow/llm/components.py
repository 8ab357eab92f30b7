"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandflow.llm.common import checkpointed


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node of ``links``: root is the least node that it reaches.

    Every step is a minimum per node, combined before the shuffle, and a join back to the links, so a node with very
    many links is no task's alone. Each round is written to the checkpoint folder; the driver sees a count and a sum.
    """
    x, y = F.col(a), F.col(b)
    edges = checkpointed(links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = checkpointed(small.select("e.u", "e.v").where("u > v").distinct())
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
