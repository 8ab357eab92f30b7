"""Batches that keep the order: runs of like operations of one index, never longer than the batch size.

The sink takes operations of an index in epochs of ``batch_size``; within an epoch a change of kind starts a new batch.
Where a wall-clock flush would cut earlier isn't a property of the data and left out; the final documents don't depend
on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandflow.operators.ranges import number, ordered, previous, running_sum

ORDER = ("seq", "row_no", "sub_no")


def runs(ops: DataFrame, batch_size: int | None = None) -> DataFrame:
    """``ops`` with batch_no from 1 in each index: a new one where the kind of operation or the epoch changes."""
    rows = ordered(ops, *ORDER, by=("index",)).settled().scan(_n=number(), _last=previous("op"))
    same = F.col("_last").eqNullSafe(F.col("op"))
    if batch_size:
        same = same & ((F.col("_n") - 1) % batch_size != 0)
    rows = rows.with_column("_starts", F.when(same, 0).otherwise(1)).settled().scan(batch_no=running_sum("_starts"))
    return rows.done().drop("_n", "_last", "_starts")


def batches(ops: DataFrame, batch_size: int) -> DataFrame:
    """(index, batch_no, op, n_ops, first_seq, last_seq, event_ids): one row for each batch, in order to be submitted.

    ``event_ids`` are the distinct events of the batch in order; at most ``batch_size``, so the list is bounded.
    """
    first = F.array_sort(F.collect_list(F.struct(*ORDER, "event_id")))
    ids = F.array_distinct(F.transform(first, lambda x: x["event_id"]))
    made = runs(ops, batch_size).groupBy("index", "batch_no")
    return made.agg(F.first("op").alias("op"), F.count("*").alias("n_ops"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), ids.alias("event_ids"))
