"""Batches over HTTP to a search service: in order, a bounded number in flight, failing fast and without payloads in errors.

The transport is a function, so the sink needs no client library: ``send(method, path, body) -> reply``. ``body`` is a
list of documents or ids; a reply to a batch has a task id, a reply about a task its status.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterable
from functools import partial, reduce
from itertools import groupby
from typing import Any
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandflow.functions.values import json_text
from strandflow.operators.batches import runs
from strandflow.operators.metrics import RunMetrics, sanitized
from strandflow.operators.snapshot import keyed_documents
from strandflow.plans.plan import TablePlan
from strandflow.spec import SearchSpec

Send = Callable[[str, str, Any], dict]


class SinkError(RuntimeError):
    """A batch that the service refused or that timed out; says the code, never the content."""


def transport(method: str, path: str, body: Any, *, host: str, api_key: str | None = None, timeout_s: float = 60.0) -> dict:
    """One request with a JSON body; the reply's JSON. A status of 400 or more is an error with its code."""
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {api_key}"} if api_key else {})
    data = None if body is None else body if isinstance(body, bytes) else json.dumps(body).encode()
    request = urllib.request.Request(host.rstrip("/") + path, data, head, method=method)
    with urllib.request.urlopen(request, timeout=timeout_s) as reply:
        return json.loads(reply.read() or b"{}")


class SearchSink:
    """Batches of one writer, in order. ``timings`` gathers seconds of requests and of waiting for tasks."""

    def __init__(self, send: Send, max_in_flight: int = 8, poll_s: float = 0.1, timeout_s: float = 300.0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.send, self.most, self.poll_s, self.timeout_s, self.sleep, self.clock = send, max_in_flight, poll_s, timeout_s, sleep, clock
        self.pending: deque[tuple[int, str, int]] = deque()
        self.done = 0
        self.timings = {"http": 0.0, "task_wait": 0.0}

    @property
    def pending_operations(self) -> int:
        """Operations that were sent and aren't confirmed yet."""
        return sum(n for _, _, n in self.pending)

    def _call(self, method: str, path: str, body: Any) -> dict:
        began = time.monotonic()
        try:
            return self.send(method, path, body)
        except Exception as error:  # the cause may hold documents, so it isn't chained
            raise SinkError(f"{method} failed: {sanitized(error)}") from None
        finally:
            self.timings["http"] += time.monotonic() - began

    def submit(self, index: str, op: str, key: str, items: list) -> None:
        """One batch of documents or ids; waits for the oldest while as many as allowed are under way."""
        if not items:
            return
        path = f"/indexes/{quote(index, '')}/documents" + ("/delete-batch" if op == "delete" else f"?primaryKey={quote(key, '')}")
        self._track(self._call("POST", path, items), op, len(items))

    def _track(self, reply: dict, op: str, n: int) -> None:
        self.pending.append((int(reply["taskUid"]), op, n))
        while len(self.pending) >= self.most:
            self._wait()

    def _exists(self, index: str) -> bool:
        try:
            self.send("GET", f"/indexes/{quote(index, '')}", None)
        except Exception as error:
            if getattr(error, "code", None) == 404:
                return False
            raise SinkError(f"GET failed: {sanitized(error)}") from None
        return True

    def prepare(self, plans: list[TablePlan], recreate: bool = False, clear: bool = False) -> None:
        """Each distinct index once: made if it is missing, made anew or emptied if asked, then its settings."""
        for index in dict.fromkeys(p.spec.index for p in plans):
            mine, at = [p for p in plans if p.spec.index == index], f"/indexes/{quote(index, '')}"
            self.flush()
            found = self._exists(index)
            if found and recreate:
                self._track(self._call("DELETE", at, None), "delete index", 0)
                self.flush()
            if not found or recreate:
                self._track(self._call("POST", "/indexes", {"uid": index, "primaryKey": mine[0].spec.target_key}), "create index", 0)
            elif clear:
                self._track(self._call("DELETE", f"{at}/documents", None), "clear index", 0)
            settings = reduce(lambda a, p: a | p.spec.settings, mine, {})
            self._track(self._call("PATCH", f"{at}/settings", {_camel(k): v for k, v in settings.items()}), "settings", 0)
            self.flush()

    def _wait(self) -> None:
        task, op, _ = self.pending.popleft()
        until, began = self.clock() + self.timeout_s, time.monotonic()
        while True:
            reply = self._call("GET", f"/tasks/{task}", None)
            status = reply.get("status")
            if status == "succeeded":
                self.done += 1
                self.timings["task_wait"] += time.monotonic() - began
                return
            if status in ("failed", "canceled"):
                code = str((reply.get("error") or {}).get("code", "unknown"))
                raise SinkError(f"{op} task {task} {status}: {code if code.replace('_', '').isalnum() else 'unknown'}")
            if self.clock() >= until:
                raise SinkError(f"{op} task {task} took longer than {self.timeout_s:g} s")
            self.sleep(self.poll_s)

    def flush(self) -> None:
        while self.pending:
            self._wait()

    def write(self, batches: Iterable[tuple[str, str, str, list]]) -> int:
        """Batches (index, op, key, items) in order, all confirmed; the number of them."""
        before = self.done
        for index, op, key, items in batches:
            self.submit(index, op, key, items)
        self.flush()
        return self.done - before


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(x.capitalize() for x in rest)


def in_order(numbered: DataFrame):
    """Batches of ``batches.runs`` for ``write``, one after the other; the driver holds one partition at a time."""
    rows = numbered.orderBy("index", "batch_no", "seq", "row_no", "sub_no").toLocalIterator(prefetchPartitions=True)
    for (index, _, op, key), part in groupby(rows, key=lambda r: (r["index"], r["batch_no"], r["op"], r["pk_field"])):
        yield index, op, key, [r["document_id"] if op == "delete" else r["document"].asDict(recursive=True) for r in part]


def write_ordered(numbered: DataFrame, make: Callable[[], SearchSink]) -> list[dict]:
    """Batches of ``batches.runs`` sent by the executors: one ordered writer an index, made there by ``make``.

    A service takes an index's operations in one order, so that is as many writers as there can be. Each holds one batch
    at a time. Returns a row for each writer's index: batches, operations, bytes and milliseconds.
    """
    rows = numbered.select("index", "batch_no", "op", "pk_field", "document_id", json_text(F.col("document")).alias("document"), "seq", "row_no", "sub_no")
    rows = rows.repartition("index").sortWithinPartitions("index", "batch_no", "seq", "row_no", "sub_no")

    def send(parts):
        sink = make()
        each = (r for part in parts for r in part.to_pylist())
        for index, of_index in groupby(each, key=lambda r: r["index"]):
            n = size = 0
            for (_, op, key), batch in groupby(of_index, key=lambda r: (r["batch_no"], r["op"], r["pk_field"])):
                items = [r["document_id"] if op == "delete" else json.loads(r["document"]) for r in batch]
                sink.submit(index, op, key, items)
                n += len(items)
                size += len(json.dumps(items))
            sink.flush()
            yield pa.RecordBatch.from_pylist([{"index": index, "batches": sink.done, "operations": n, "bytes": size, **{k: int(1000 * v) for k, v in sink.timings.items()}}])
            sink.done, sink.timings = 0, dict.fromkeys(sink.timings, 0.0)

    return [r.asDict() for r in rows.mapInArrow(send, "index string, batches long, operations long, bytes long, http long, task_wait long").collect()]


class SearchStore:
    """A service as the place that a pipeline writes to: the same calls as an ``IndexStore``."""

    def __init__(self, spec: SearchSpec, metrics: RunMetrics | None = None):
        self.spec, self.metrics = spec, metrics
        send = partial(transport, host=spec.host, api_key=spec.api_key, timeout_s=float(spec.task_timeout_secs))
        self.make = partial(SearchSink, send, spec.max_in_flight_tasks, spec.task_poll_ms / 1000, float(spec.task_timeout_secs))

    def prepare(self, plans: list[TablePlan], recreate: bool = False, clear: bool = False) -> None:
        self.make().prepare(plans, recreate, clear)

    def apply(self, index: str, ops: DataFrame, batch: str) -> None:
        """``ops`` in batches of the configured size, all confirmed when this returns; sending them again changes nothing."""
        sent = write_ordered(runs(ops, self.spec.batch_size), self.make)
        if self.metrics:
            for row in sent:
                self.metrics.batches += row["batches"]
                for k in ("http", "task_wait"):
                    self.metrics.stage_ms[k] = self.metrics.stage_ms.get(k, 0) + row[k]

    def load_snapshot(self, plans: list[TablePlan]) -> None:
        for p in plans:
            rows = keyed_documents(p).withColumns({"op": F.lit("upsert"), "seq": F.monotonically_increasing_id(), "row_no": F.lit(0), "sub_no": F.lit(1)})
            self.apply(p.spec.index, rows, "snapshot")
