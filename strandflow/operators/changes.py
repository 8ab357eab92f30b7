"""Operations from row images: what an insert, update or delete of a source row means for its documents.

A change has an image of the row before, after, or both. A column of an image is absent, known, or present but unknown
(a partial update of a value); SQL NULL is a known value. ``before_present`` and ``after_present`` list the columns an
image has (null: all), ``before_unknown`` and ``after_unknown`` those whose value it lacks (null: none).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandflow.plans.plan import TablePlan, column_of

UPSERT, DELETE, IGNORED = "upsert", "delete", "ignored"


def _has(side: str, name: str) -> Column:
    listed = F.array_contains(f"{side}_present", name)
    return F.col(side).isNotNull() & F.coalesce(listed, F.lit(True))


def _knows(side: str, name: str) -> Column:
    missing = F.array_contains(f"{side}_unknown", name)
    return _has(side, name) & ~F.coalesce(missing, F.lit(False))


def named(events: DataFrame, plan: TablePlan) -> DataFrame:
    """``events`` with the images' columns under their names where the log only has their places (@0, @1, ...)."""
    own = plan.schema.names
    for side in ("before", "after"):
        fields = events.schema[side].dataType.names
        if any(f.startswith("@") for f in fields):
            image = F.struct(*[F.col(side)[f].alias(column_of(f, own)) for f in fields])
            events = events.withColumn(side, F.when(F.col(side).isNotNull(), image))
    known = F.lit(own)
    for column in (f"{s}_{n}" for s in ("before", "after") for n in ("present", "unknown")):
        if column in events.columns:
            at = lambda c: F.when(c.startswith("@"), F.element_at(known, F.substring(c, 2, 9).try_cast("int") + 1)).otherwise(c)
            events = events.withColumn(column, F.transform(column, at))
    return events


def complete(plan: TablePlan, side: str = "after") -> Column:
    """Whether an image has a known value for every field of the document."""
    return reduce(Column.__and__, (_knows(side, f) for f in plan.spec.fields))


def touches(plan: TablePlan) -> Column:
    """Whether an update concerns the document: a field or watched field that the after image has and that changed.

    Where either side doesn't know the value, it may have changed; NULL is equal to NULL.
    """
    names = dict.fromkeys((*plan.spec.fields, *plan.spec.watch_fields))
    changed = [
        _has("after", n) & F.when(_knows("before", n) & _knows("after", n), ~F.col("before")[n].eqNullSafe(F.col("after")[n])).otherwise(F.lit(True))
        for n in names
    ]
    return reduce(Column.__or__, changed)


def derived(events: DataFrame, plan: TablePlan) -> DataFrame:
    """``events`` with kind, pk, document_id, previous_id, needs_fetch and document for one plan.

    An insert upserts the after image, a delete deletes the before image's key (whatever the filter says), an update
    that touches nothing is ignored, any other upserts under the key of the after image, or else of the before image.
    A missing key is an error.
    """
    events = named(events, plan)
    key, spec = plan.spec.primary_key, plan.spec
    no_key = F.raise_error(F.concat(F.lit(f"no {key} in an image of "), F.col("event_id")))
    insert, delete = F.col("before").isNull() & F.col("after").isNotNull(), F.col("before").isNotNull() & F.col("after").isNull()
    update = F.col("before").isNotNull() & F.col("after").isNotNull()
    kind = F.when(insert | (update & touches(plan)), UPSERT).when(delete, DELETE).otherwise(IGNORED)
    before, after = F.col("before")[key], F.col("after")[key]
    pk = F.when(delete, F.when(_knows("before", key), before).otherwise(no_key.cast(plan.kind(key))))
    pk = pk.when(insert | update, F.when(_knows("after", key), after).when(update & _knows("before", key), before).otherwise(no_key.cast(plan.kind(key))))
    previous = F.when(update & _knows("before", key), plan.key_text(F.col("before")))
    needs = (F.col("kind") == UPSERT) & (F.lit(spec.where_clause is not None) | ~complete(plan))
    out = events.withColumn("event_id", F.concat_ws(":", "file", "pos")).withColumn("kind", kind)
    out = out.withColumn("pk", F.when(F.col("kind") != IGNORED, pk)).withColumn("needs_fetch", needs)
    out = out.withColumn("document_id", F.when(F.col("kind") != IGNORED, plan.key_text(F.struct(F.col("pk").alias(key)))))
    out = out.withColumn("previous_id", F.when(F.col("kind") == UPSERT, previous))
    return out.withColumn("document", F.when((F.col("kind") == UPSERT) & ~F.col("needs_fetch"), plan.document(F.col("after"))))


def operations(events: DataFrame, plan: TablePlan) -> DataFrame:
    """The op log of one plan: (index, pk_field, document_id, op, document, pk, seq, row_no, sub_no, event_id, reread, reason).

    A changed key deletes the old document before it upserts the new one. Upserts with ``reread`` have no document yet.
    """
    rows = derived(events, plan).where(F.col("kind") != IGNORED)
    empty = F.lit(None).cast(plan_document_type(plan))
    moved = (F.col("kind") == UPSERT) & F.col("previous_id").isNotNull() & (F.col("previous_id") != F.col("document_id"))
    old = F.struct(F.lit(0).alias("sub_no"), F.lit(DELETE).alias("op"), F.col("previous_id").alias("document_id"), empty.alias("document"), F.lit(False).alias("reread"), F.lit("key changed").alias("reason"))
    reason = F.when(F.col("kind") == DELETE, "row deleted").when(F.col("needs_fetch"), "image incomplete or filtered").otherwise("image complete")
    new = F.struct(F.lit(1).alias("sub_no"), F.col("kind").alias("op"), F.col("document_id"), F.col("document"), F.col("needs_fetch").alias("reread"), reason.alias("reason"))
    each = F.explode(F.when(moved, F.array(old, new)).otherwise(F.array(new)))
    rows = rows.select("seq", "row_no", "event_id", "pk", each.alias("o"))
    return rows.select(
        F.lit(plan.spec.index).alias("index"), F.lit(plan.spec.target_key).alias("pk_field"), "o.document_id", "o.op", "o.document",
        "pk", "seq", "row_no", "o.sub_no", "event_id", "o.reread", "o.reason",
    )


def plan_document_type(plan: TablePlan):
    return plan.source.limit(0).select(plan.document().alias("d")).schema["d"].dataType


def expanded(events: DataFrame) -> DataFrame:
    """One row for each (before, after) pair of an event's ``rows``, numbered in order as row_no."""
    other = [c for c in events.columns if c != "rows"]
    return events.select(*other, F.posexplode("rows").alias("row_no", "row")).select(*other, "row_no", "row.*")
