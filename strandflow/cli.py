"""Command line: run, snapshot, cdc and position over a specification and a folder of tables and change files.

    python -m strandflow.cli --config pipeline.toml --tables DIR --changes DIR --store DIR run

``--tables`` has one Parquet dataset a source table, ``--changes`` one folder of change files a table and one named
``transactions`` with the log's transaction marks; where databases share a table's name, each has a folder of its own.
"""

from __future__ import annotations

import argparse
import json
import re
import signal
import sys
import threading

from pyspark.sql import DataFrame, SparkSession

from strandflow import spec
from strandflow.operators.metrics import RunMetrics
from strandflow.plans.plan import TablePlan, bind_all
from strandflow.session import build_session
from strandflow.sources import state, tables
from strandflow.sources.files import Files
from strandflow.sources.index_store import IndexStore
from strandflow.sources.search_http import SearchStore
from strandflow.sources.state import Position
from strandflow.streaming import pipeline


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="strandflow", description="Keeps document indexes in step with source tables.")
    out.add_argument("--config", default="config.toml")
    out.add_argument("--metrics", action="store_true", help="print volumes and timings of the run")
    out.add_argument("--tables", required=True, help="a folder of Parquet datasets, or jdbc for the database of source.url")
    out.add_argument("--changes")
    out.add_argument("--store", default="indexes", help="the folder of indexes, or of checkpoints if the sink is http")
    out.add_argument("--sink", choices=("files", "http"), default="files", help="index files under --store, or the service at search.host")
    commands = out.add_subparsers(dest="command")
    for name in ("run", "snapshot"):
        c = commands.add_parser(name)
        c.add_argument("--recreate-indexes", action="store_true")
        c.add_argument("--clear-documents", action="store_true")
        if name == "run":
            c.add_argument("--force-snapshot", action="store_true")
            c.add_argument("--follow", action="store_true", help="go on until it is told to stop")
    cdc = commands.add_parser("cdc")
    cdc.add_argument("--file")
    cdc.add_argument("--pos", type=int)
    cdc.add_argument("--follow", action="store_true", help="go on until it is told to stop")
    commands.add_parser("position")
    return out


def _plans(spark: SparkSession, args: argparse.Namespace, pipe: spec.PipelineSpec) -> list[TablePlan]:
    known = list(dict.fromkeys((t.database, t.table) for t in pipe.tables))
    if args.tables == "jdbc":
        return bind_all(pipe.tables, {(d, t): tables.jdbc(spark, f"jdbc:{pipe.source.url}", f"{d}.{t}" if d else t) for d, t in known})
    files = Files(spark, args.tables)
    return bind_all(pipe.tables, {(d, t): tables.parquet(spark, tables.place(files, d, t, known, ".parquet")) for d, t in known})


def _changes(spark: SparkSession, args: argparse.Namespace, plans: list[TablePlan], stream: bool) -> tuple[DataFrame, dict]:
    return tables.change_log(spark, args.changes, {(p.spec.database, p.spec.table): p.schema for p in plans}, stream)


def current(spark: SparkSession, args: argparse.Namespace, plans: list[TablePlan]) -> Position:
    """The last position of the change log; 0 of no file if it is empty."""
    row = tables.last_position(_changes(spark, args, plans, False)[0]).first()
    return Position(row["file"], row["pos"]) if row["file"] is not None else Position("", 0)


def execute(spark: SparkSession, args: argparse.Namespace, stop: threading.Event | None = None) -> dict | None:
    pipe = spec.load(args.config)
    plans = _plans(spark, args, pipe)
    if args.command == "position":
        print(current(spark, args, plans))
        return None
    command = args.command or "run"
    run = RunMetrics({"run": "full"}.get(command, command))
    try:
        with run.running():
            _execute(spark, args, pipe, plans, command, run, stop or threading.Event())
    except BaseException:
        if args.metrics:
            print(json.dumps(run.report()))
        raise
    return run.report()


def _execute(spark: SparkSession, args: argparse.Namespace, pipe: spec.PipelineSpec, plans: list[TablePlan], command: str, run: RunMetrics, stop: threading.Event) -> None:
    store = SearchStore(pipe.search, run) if args.sink == "http" else IndexStore(spark, args.store)
    saved = state.load(pipe.runtime.state_path)
    rebuild = {"recreate": getattr(args, "recreate_indexes", False), "clear": getattr(args, "clear_documents", False)}
    if command == "snapshot":
        store.prepare(plans, **rebuild)
        with run.stage("snapshot"):
            store.load_snapshot(plans)
        return
    # the position comes first: what changes during the snapshot is replayed after it
    with run.stage("source_read"):
        now = current(spark, args, plans)
    force = getattr(args, "force_snapshot", False)
    asked = (getattr(args, "file", None), getattr(args, "pos", None))
    start = state.start_position(*asked, None if force else saved, now if command == "cdc" else Position("", 0))
    if command == "run":
        if saved and any(rebuild.values()) and not force:
            raise ValueError("a saved position exists: rebuilding the indexes needs --force-snapshot")
        snapshot = force or (pipe.runtime.snapshot_on_start and saved is None)
        store.prepare(plans, **{k: v and snapshot for k, v in rebuild.items()})
        if snapshot:
            with run.stage("snapshot"):
                store.load_snapshot(plans)
    else:
        store.prepare(plans)
    events, images = _changes(spark, args, plans, True)
    if start.file:
        events = tables.from_position(events, start.file, start.pos)
    # a position that is asked for is read from anew, whatever an earlier stream has seen
    name = "log" if asked[0] is None else "log-" + re.sub(r"\W+", "_", f"{asked[0]}-{asked[1]}")
    folder = f"{args.store}/_checkpoints/{name}"
    limits = {"every_events": pipe.runtime.checkpoint_every_events, "every_ms": pipe.runtime.flush_interval_ms}
    commit = pipeline.SafeCheckpoint(Files(spark, folder), start, lambda at: state.save(pipe.runtime.state_path, at), **limits)
    every = pipe.runtime.flush_interval_ms if getattr(args, "follow", False) else None
    query = pipeline.start(events, store, plans, f"{folder}/stream", every_ms=every, metrics=run, commit=commit, images=images)
    try:
        pipeline.follow(query, stop)
    finally:
        commit.finish()


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        spec.load(args.config)  # before anything connects
    except (OSError, ValueError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 1
    stop = threading.Event()
    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, lambda *_: stop.set())
    report = execute(build_session(), args, stop)
    if args.metrics and report:
        print(json.dumps(report))
    return 0


if __name__ == "__main__":
    sys.exit(main())
