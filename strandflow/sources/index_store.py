"""Destination indexes as Parquet: a base version, the batches appended since, and a pointer that is swapped whole.

A version and a batch hold the last operation of each of their documents, deletes too, so a batch that is applied again
changes nothing. Applying a batch writes that batch only; after COMPACT of them they are merged into a new version. What
a reader may still hold stays for GRACE seconds. Reading the current index leaves the deletes out.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandflow.operators.apply import last_operations, live, ops_columns
from strandflow.operators.snapshot import keyed_documents
from strandflow.plans.plan import TablePlan
from strandflow.sources.files import Files


#: Appended batches that are merged into a version, and seconds that replaced files stay.
COMPACT, GRACE = 16, 3600


class IndexStore:
    """Indexes under ``root``, a folder that all executors share. Each has versions, a pointer and its settings."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    def _read(self, index: str) -> dict:
        return json.loads(self.files.read(f"{index}/current.json") or "{}")

    def _swap(self, index: str, value: dict) -> None:
        self.files.replace(f"{index}/current.json", json.dumps(value))

    def exists(self, index: str) -> bool:
        return bool(self._read(index))

    def settings(self, index: str) -> dict:
        return self._read(index).get("settings", {})

    def state(self, index: str) -> DataFrame | None:
        """The last operation of every document, or None if nothing was applied yet."""
        now = self._read(index)
        parts = [self.spark.read.parquet(self.files.path(f"{index}/{v}")) for v in ([now["version"]] if now.get("version") else []) + now.get("appended", [])]
        if len(parts) < 2:
            return parts[0] if parts else None
        return last_operations(reduce(DataFrame.unionByName, parts))

    def documents(self, index: str) -> DataFrame | None:
        state = self.state(index)
        return None if state is None else live(state).select("document_id", "document.*")

    def prepare(self, plans: list[TablePlan], recreate: bool = False, clear: bool = False) -> None:
        """Each distinct index once: made if it is missing, emptied if asked, and its settings applied."""
        for index in dict.fromkeys(p.spec.index for p in plans):
            now = self._read(index)
            if recreate:
                self.files.delete(index)
                now = {}
            elif clear:
                now = {"settings": now.get("settings", {})}
            wanted: dict = {}
            for p in plans:
                if p.spec.index == index:
                    wanted |= {"primary_key": p.spec.target_key} | p.spec.settings
            self._swap(index, now | {"settings": now.get("settings", {}) | wanted})

    def apply(self, index: str, ops: DataFrame, batch: str) -> None:
        """The index after ``ops``. Files are named by ``batch``: doing it again writes the same rows again."""
        now = self._read(index)
        if now.get("batch") == batch:
            return
        added = f"b-{batch}"
        last_operations(ops.select(*ops_columns())).write.mode("overwrite").parquet(self.files.path(f"{index}/{added}"))
        now = now | {"appended": [*now.get("appended", []), added], "batch": batch}
        self._swap(index, now)
        if len(now["appended"]) >= COMPACT:
            self.compact(index)

    def compact(self, index: str) -> None:
        """One version of what the base and the appended batches hold; what was replaced GRACE seconds ago goes."""
        now, state = self._read(index), self.state(index)
        if state is None or not now.get("appended"):
            return
        version = f"v-{now['batch']}"
        state.write.mode("overwrite").parquet(self.files.path(f"{index}/{version}"))
        replaced = [[time.time(), v] for v in [now.get("version"), *now["appended"]] if v and v != version]
        old = [*now.get("replaced", []), *replaced]
        keep = [[t, v] for t, v in old if t > time.time() - GRACE]
        self._swap(index, now | {"version": version, "appended": [], "replaced": keep})
        for t, v in old:
            if [t, v] not in keep:
                self.files.delete(f"{index}/{v}")

    def load_snapshot(self, plans: list[TablePlan]) -> None:
        """Every document of the plans, after what the index has of earlier runs and before any later change."""
        for index in dict.fromkeys(p.spec.index for p in plans):
            state = self.state(index)
            seq = -1 if state is None else state.agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0]
            mine = [keyed_documents(p) for p in plans if p.spec.index == index]
            rows = reduce(DataFrame.unionByName, mine)
            last = [F.lit(seq).cast("long").alias("seq"), F.lit((1 << 31) - 1).alias("row_no"), F.lit(1).alias("sub_no")]
            self.apply(index, rows.select("index", "document_id", F.lit("upsert").alias("op"), "document", *last), f"snapshot-{uuid.uuid4().hex}")
