"""The change pipeline as a stream: each micro-batch becomes an op log, rereads what it must, and is applied.

Order comes from the log's ``seq``, never from time. A micro-batch that fails is done again as a whole and applied under
its number, so documents converge; ``SafeCheckpoint`` moves the exported position only after the batch is applied, and
only to a place where no transaction is open.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandflow.operators.changes import operations
from strandflow.operators.metrics import RunMetrics
from strandflow.operators.positions import LogState, advanced
from strandflow.operators.reread import resolved
from strandflow.plans.plan import TablePlan
from strandflow.sources.files import Files
from strandflow.sources.index_store import IndexStore
from strandflow.sources.state import Position


class SafeCheckpoint:
    """What a stream does once a batch is applied: follows the log and saves the last place where nothing is open.

    The state of the log is kept in ``files`` beside the stream's checkpoint, so a transaction that is open when a run
    ends is still open for the next. The exported position is saved when ``every_events`` events or ``every_ms`` have
    gone by since the last time, and by ``finish``.
    """

    def __init__(self, files: Files, start: Position, save: Callable[[Position], None], every_events: int = 1000, every_ms: int = 1000, clock: Callable[[], float] = time.monotonic):
        self.files, self.export, self.every_events, self.every_ms, self.clock = files, save, every_events, every_ms, clock
        kept = files.read("log.json")
        self.state = LogState(**json.loads(kept)) if kept else LogState.at(start.file, start.pos)
        self.events, self.last, self.saved = 0, clock(), None if kept else Position(start.file, start.pos)

    def __call__(self, events: DataFrame) -> None:
        log = events.select("seq", "kind", "query", F.col("pos").alias("log_pos"), "rotate_file", "rotate_pos", "file")
        self.state = advanced(log, self.state)
        self.files.replace("log.json", json.dumps(asdict(self.state)))
        self.events += events.count()
        if self.events >= self.every_events or 1000 * (self.clock() - self.last) >= self.every_ms:
            self.finish()

    def finish(self) -> None:
        """Saves the safe position if it moved."""
        safe = Position(self.state.safe_file, self.state.safe_pos)
        if safe != self.saved and safe.file:
            self.export(safe)
            self.saved = safe
        self.events, self.last = 0, self.clock()


def follow(query: StreamingQuery, stop: threading.Event, poll_s: float = 0.2) -> None:
    """Waits for the stream's end, or stops it once ``stop`` is set and the batch under way is done."""
    while query.isActive and not query.awaitTermination(poll_s):
        if stop.is_set():
            while query.isActive and query.status["isTriggerActive"]:
                time.sleep(poll_s)
            query.stop()
    if error := query.exception():
        raise error


def op_log(events: DataFrame, plans: list[TablePlan], images: dict | None = None) -> list[DataFrame]:
    """The resolved op log of each plan that ``events`` concern; one event serves every plan of its table.

    ``images`` names the column that has a table's images, where a log has those of several tables.
    """
    out = []
    for p in plans:
        mine = events.where((F.col("database").eqNullSafe(F.lit(p.spec.database))) & (F.col("table") == p.spec.table))
        if images:
            mine = mine.select("seq", "file", "pos", "kind", "row_no", f"{images[p.spec.database, p.spec.table]}.*")
        mine = mine.where((F.col("kind") == "rows") | F.col("kind").isNull())
        ops = operations(mine, p)
        out.append(resolved(ops, p) if p.spec.where_clause or not _full(mine) else ops)
    return out


def _full(events: DataFrame) -> bool:
    """Whether the log has no column that could make an image incomplete."""
    return not {"after_present", "after_unknown"} & set(events.columns)


def apply_batch(store: IndexStore, plans: list[TablePlan], run_name: str, metrics: RunMetrics | None = None, commit: Callable[[DataFrame], None] | None = None, images: dict | None = None) -> Callable[[DataFrame, int], None]:
    """What a stream does with each micro-batch; ``commit`` gets its events once they are applied.

    ``run_name`` tells the batches of one checkpoint from another's with the same numbers.
    """

    def run(events: DataFrame, batch_id: int) -> None:
        events.persist()
        try:
            logs = op_log(events, plans, images)
            by_index: dict[str, list[DataFrame]] = {}
            for p, ops in zip(plans, logs):
                by_index.setdefault(p.spec.index, []).append(ops)
            for index, parts in by_index.items():
                ops = reduce(DataFrame.unionByName, parts)
                if metrics:
                    with metrics.stage("transform"):
                        ops = ops.persist()
                        metrics.add_operations(ops)
                    with metrics.stage("apply"):
                        store.apply(index, ops, f"{run_name}-{batch_id}")
                    ops.unpersist()
                else:
                    store.apply(index, ops, f"{run_name}-{batch_id}")
            if commit:
                with metrics.stage("checkpoint_write") if metrics else nullcontext():
                    commit(events)
        finally:
            events.unpersist()

    return run


def start(events: DataFrame, store: IndexStore, plans: list[TablePlan], checkpoint: str, every_ms: int | None = None, metrics: RunMetrics | None = None, commit: Callable[[DataFrame], None] | None = None, images: dict | None = None) -> StreamingQuery:
    """The running stream: every ``every_ms`` milliseconds, or once over all that is there."""
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    writer = events.writeStream.foreachBatch(apply_batch(store, plans, name, metrics, commit, images)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{every_ms} milliseconds") if every_ms else writer.trigger(availableNow=True)
    return writer.start()


def run(events: DataFrame, store: IndexStore, plans: list[TablePlan], checkpoint: str, resumed: bool, snapshot_on_start: bool = True, force_snapshot: bool = False, recreate: bool = False, clear: bool = False, **options) -> StreamingQuery:
    """Snapshot, then changes: ``events`` must start at a position taken before this call, so the overlap is replayed.

    A saved position skips the snapshot unless it is forced; asking to rebuild without that is an error.
    """
    if resumed and (recreate or clear) and not force_snapshot:
        raise ValueError("a saved position exists: rebuilding the indexes needs force_snapshot")
    snapshot = force_snapshot or (snapshot_on_start and not resumed)
    store.prepare(plans, recreate and snapshot, clear and snapshot)
    if snapshot:
        store.load_snapshot(plans)
    return start(events, store, plans, checkpoint, **options)
