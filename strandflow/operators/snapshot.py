"""Snapshots: the rows of a source as documents, whole or page by page in the order of the key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandflow.functions.values import json_text
from strandflow.operators.ranges import number, ordered
from strandflow.plans.plan import TablePlan, quoted


def documents(plan: TablePlan) -> DataFrame:
    """The document of each row that the plan's filter keeps; filter and columns reach the scan."""
    return plan.rows.select(*[plan.value(f).alias(plan.spec.target(f)) for f in plan.spec.fields])


def keyed_documents(plan: TablePlan) -> DataFrame:
    """(index, pk_field, document_id, document) of each row."""
    spec = plan.spec
    return plan.rows.select(F.lit(spec.index).alias("index"), F.lit(spec.target_key).alias("pk_field"), plan.key_text().alias("document_id"), plan.document().alias("document"))


def page(plan: TablePlan, after: object | None = None, size: int | None = None) -> DataFrame:
    """The first page of documents, or the one after the key ``after``: a pushed-down filter and a top-n, no offset."""
    key = plan.spec.primary_key
    rows = plan.rows if after is None else plan.rows.where(F.col(quoted(key)) > F.lit(after))
    rows = rows.orderBy(quoted(key)).limit(size or plan.spec.snapshot_batch_size)
    return rows.select(*[plan.value(f).alias(plan.spec.target(f)) for f in plan.spec.fields])


def _cut(plan: TablePlan, size: int) -> DataFrame:
    key = plan.spec.primary_key
    numbered = ordered(plan.rows.select(F.col(quoted(key)).alias("key")), "key").scan(n=number()).done()
    return numbered.select("key", F.floor((F.col("n") - 1) / size).alias("part"))


def parts(plan: TablePlan, size: int) -> DataFrame:
    """(part, n_rows, first_key, last_key) when the rows are cut in order of the key into parts of ``size``.

    With the page size these are the pages, with the sink's batch size the batches, which run across pages.
    """
    return _cut(plan, size).groupBy("part").agg(F.count("*").alias("n_rows"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


def lookup(plan: TablePlan, key: object) -> DataFrame:
    """The current document of one key, or nothing if it is gone or the filter excludes it."""
    return plan.rows.where(F.col(quoted(plan.spec.primary_key)) == F.lit(key)).limit(1).select(*[plan.value(f).alias(plan.spec.target(f)) for f in plan.spec.fields])


def merged(plans: list[TablePlan]) -> DataFrame:
    """Documents of several plans as (index, document_id, document JSON): many sources to one index, or one to many."""
    each: list[Column] = [F.col("index"), F.col("document_id"), json_text(F.col("document")).alias("document")]
    return reduce(DataFrame.unionByName, (keyed_documents(p).select(*each) for p in plans))
