"""Applying an op log: the last operation of a document id wins, so replays change nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandflow.operators.batches import ORDER
from strandflow.operators.changes import DELETE


def last_operations(ops: DataFrame) -> DataFrame:
    """(index, document_id, op, document, seq, row_no, sub_no): the last operation of each document.

    A maximum, combined before the shuffle; deletes stay as tombstones. Ties (replays) are the same operation.
    """
    last = F.max_by(F.struct("op", "document"), F.struct(*ORDER))
    won = ops.groupBy("index", "document_id").agg(last.alias("w"), F.max(F.struct(*ORDER)).alias("o"))
    return won.select("index", "document_id", "w.op", "w.document", *[f"o.{c}" for c in ORDER])


def live(state: DataFrame) -> DataFrame:
    return state.where(F.col("op") != DELETE)


def merged(state: DataFrame, ops: DataFrame) -> DataFrame:
    """The state after ``ops``; operations that are no later than what the state has change nothing."""
    return last_operations(state.select(*ops_columns()).unionByName(ops.select(*ops_columns())))


def ops_columns() -> list[str]:
    return ["index", "document_id", "op", "document", *ORDER]
