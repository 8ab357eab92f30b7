"""Rereads: upserts whose image can't make the document get the source's current row, or become deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandflow.operators.changes import DELETE
from strandflow.plans.plan import TablePlan, quoted


def resolved(ops: DataFrame, plan: TablePlan) -> DataFrame:
    """The op log with every reread done: one left join by key, and only for the upserts that need it.

    A key that the source lacks, or that its filter excludes, is deleted. The row read is the current one, not the one
    at the time of the change; later changes follow and the documents converge.
    """
    ready = ops.where(~F.col("reread"))
    current = plan.rows.select(F.col(quoted(plan.spec.primary_key)).alias("_key"), plan.document().alias("_now"))
    asked = ops.where("reread").join(current, F.col("pk") == F.col("_key"), "left")
    gone = F.col("_now").isNull()
    done = asked.withColumn("op", F.when(gone, DELETE).otherwise(F.col("op"))).withColumn("reason", F.when(gone, "missing or excluded").otherwise("reread"))
    return ready.unionByName(done.withColumn("document", F.col("_now")).select(*ops.columns))
