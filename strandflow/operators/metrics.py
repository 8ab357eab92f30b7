"""Run metrics: volumes by aggregates, ratios that are 0 where there is nothing to divide by, timers, resources."""

from __future__ import annotations

import os
import resource
import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandflow.functions.values import json_bytes

MODES = {"full": "full", "snapshot": "snapshot", "cdc": "cdc"}


def ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0)))


def volumes(ops: DataFrame, batch_size: int | None = None) -> DataFrame:
    """(operations, upserts, deletes, documents_with_body, bytes_sent): what an op log moves, in one pass."""
    upsert = F.col("op") == "upsert"
    return ops.agg(
        F.count("*").alias("operations"), F.count_if(upsert).alias("upserts"), F.count_if(~upsert).alias("deletes"),
        F.count("document").alias("documents_with_body"), F.coalesce(F.sum(json_bytes(F.col("document"))), F.lit(0)).cast("long").alias("bytes_sent"),
    )


@dataclass
class RunMetrics:
    """Counters and timers of one run. ``documents_indexed`` counts deletes too; stage timers overlap, so they don't add up."""

    mode: str
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    documents_read: int = 0
    documents_indexed: int = 0
    documents_failed: int = 0
    bytes_sent: int = 0
    batches: int = 0
    stage_ms: dict[str, int] = field(default_factory=dict)
    started: float = field(default_factory=time.monotonic)
    status: str = "running"
    error: str | None = None
    peak_rss_mb: int = 0
    last_rss_mb: int = 0
    virtual_mb: int = 0
    _cpu: float = field(default_factory=time.process_time, repr=False)

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is none of {', '.join(MODES)}")

    @contextmanager
    def stage(self, name: str):
        began = time.monotonic()
        try:
            yield
        finally:
            self.stage_ms[name] = self.stage_ms.get(name, 0) + int(1000 * (time.monotonic() - began))

    @contextmanager
    def running(self, period_s: float = 0.5):
        """Samples this process's memory while the run goes on, and notes how it ended."""
        done = threading.Event()

        def watch():
            while True:
                self.sample()
                if done.wait(period_s):
                    return

        thread = threading.Thread(target=watch, daemon=True)
        thread.start()
        try:
            yield self
            self.status = "succeeded"
        except BaseException as error:
            self.status, self.error = "failed", sanitized(error)
            raise
        finally:
            done.set()
            thread.join()

    def sample(self) -> None:
        with open("/proc/self/statm", encoding="ascii") as f:
            pages = [int(x) for x in f.read().split()[:2]]
        virtual, rss = (p * os.sysconf("SC_PAGE_SIZE") >> 20 for p in pages)
        self.virtual_mb, self.last_rss_mb, self.peak_rss_mb = virtual, rss, max(self.peak_rss_mb, rss)

    def add_operations(self, ops: DataFrame) -> None:
        row = volumes(ops).first()
        self.documents_read += row["documents_with_body"]
        self.documents_indexed += row["operations"]
        self.bytes_sent += row["bytes_sent"]
        self.batches += 1

    def report(self) -> dict[str, object]:
        seconds = time.monotonic() - self.started
        peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024
        own = {k: v for k, v in asdict(self).items() if k not in ("started", "_cpu")}
        return own | {
            "duration_ms": int(seconds * 1000),
            "documents_per_second": self.documents_indexed / seconds if seconds else 0.0,
            "average_batch_size": self.documents_indexed / self.batches if self.batches else 0.0,
            "average_cpu_percent": 100 * (time.process_time() - self._cpu) / seconds if seconds else 0.0,
            "peak_memory_mb": peak // (1 << 20),
        }


def sanitized(error: BaseException) -> str:
    """What may be logged of a sink's error: its kind and code, never payloads, ids, addresses or messages."""
    code = getattr(error, "code", None) or getattr(error, "status", None)
    return f"{type(error).__name__}" + (f" (code {code})" if code is not None and str(code).replace("_", "").isalnum() else "")
