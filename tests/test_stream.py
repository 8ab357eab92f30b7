import threading

import pytest
from pyspark.sql import functions as F

from strandflow import catalog
from strandflow.operators import metrics
from strandflow.plans.plan import bind
from strandflow.sources import state
from strandflow.sources.index_store import IndexStore
from strandflow.sources.search_http import SearchSink, SinkError, in_order
from strandflow.sources.state import Position
from strandflow.spec import TableSpec
from strandflow.streaming import pipeline

SIDES = [f"CAST(NULL AS array<string>) AS {s}_{n}" for s in ("before", "after") for n in ("present", "unknown")]


def stream(spark, folder):
    stored = spark.read.parquet(f"{folder}/changes")
    return spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/changes").selectExpr("*", *SIDES)


def write(df, folder, n):
    df.drop("before_present", "after_present", "before_unknown", "after_unknown").coalesce(1).write.mode("append").parquet(f"{folder}/changes")


def test_restart_goes_on_where_it_was_and_replay_changes_nothing(spark, sf_dir, tmp_path):
    log, plan = catalog._log(spark, sf_dir), catalog._users(spark, sf_dir)
    store = IndexStore(spark, str(tmp_path / "indexes"))
    write(log.where("seq < 400"), tmp_path, 0)
    store.prepare([plan])
    seen = metrics.RunMetrics("cdc")
    pipeline.start(stream(spark, tmp_path), store, [plan], str(tmp_path / "cp"), metrics=seen).awaitTermination()
    write(log.where("seq >= 400"), tmp_path, 1)
    done = []
    pipeline.start(stream(spark, tmp_path), store, [plan], str(tmp_path / "cp"), commit=lambda e: done.append(e.count())).awaitTermination()
    want = {tuple(r) for r in catalog.apply_last_write_wins(spark, sf_dir).collect()}
    assert {tuple(r) for r in catalog._final(store.state("users")).collect()} == want and sum(done) == 600
    pipeline.start(stream(spark, tmp_path), store, [plan], str(tmp_path / "cp2")).awaitTermination()
    assert {tuple(r) for r in catalog._final(store.state("users")).collect()} == want
    assert seen.report()["documents_indexed"] > 0


def test_run_takes_the_snapshot_first_and_guards_rebuilds(spark, sf_dir, tmp_path):
    plan = catalog._users(spark, sf_dir)
    source = catalog.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("event_type").alias("event_type"), F.max("props").alias("props"))
    plan = bind(plan.spec, source)
    write(catalog._log(spark, sf_dir).where("seq < 10"), tmp_path, 0)
    store = IndexStore(spark, str(tmp_path / "indexes"))
    with pytest.raises(ValueError, match="force_snapshot"):
        pipeline.run(stream(spark, tmp_path), store, [plan], str(tmp_path / "cp"), resumed=True, recreate=True)
    pipeline.run(stream(spark, tmp_path), store, [plan], str(tmp_path / "cp"), resumed=False).awaitTermination()
    assert store.state("users").count() == source.count()
    assert store.settings("users")["primary_key"] == "user_id"
    pipeline.run(stream(spark, tmp_path), store, [plan], str(tmp_path / "cp3"), resumed=True, force_snapshot=True, clear=True).awaitTermination()
    assert store.documents("users").count() <= source.count()


def test_two_tables_may_share_an_index_and_it_is_prepared_once(spark, sf_dir, tmp_path):
    plans = [bind(catalog.CUSTOMERS, catalog.table(spark, sf_dir, "customer")), bind(catalog.SUPPLIERS, catalog.table(spark, sf_dir, "supplier").withColumn("s_suppkey", F.col("s_suppkey") + 10_000))]
    store = IndexStore(spark, str(tmp_path))
    store.prepare(plans, recreate=True)
    assert store.exists("parties") and not store.exists("other") and store.state("parties") is None
    store.load_snapshot(plans)
    assert store.documents("parties").count() == sum(p.source.count() for p in plans)


def test_position_file(tmp_path):
    path = tmp_path / "state.json"
    assert state.load(path) is None
    state.save(path, Position("bin.1", 4))
    stop, bad = threading.Event(), []

    def reader():
        while not stop.is_set():
            if state.load(path) not in (Position("bin.1", 4), Position("bin.2", 8)):
                bad.append(1)

    t = threading.Thread(target=reader)
    t.start()
    for k in range(40):
        state.save(path, Position("bin.1", 4) if k % 2 else Position("bin.2", 8))
    stop.set()
    t.join()
    assert not bad and str(state.load(path)) == "bin.1:4" and [p.name for p in tmp_path.iterdir()] == ["state.json"]
    path.write_text("{")
    with pytest.raises(ValueError):
        state.load(path)
    (tmp_path / "folder").mkdir()
    with pytest.raises(OSError):
        state.save(tmp_path / "folder", Position("f", 1))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["folder", "state.json"]


def test_start_position():
    saved, now = Position("s", 1), Position("n", 2)
    assert state.start_position("f", 3, saved, now) == Position("f", 3)
    assert state.start_position(None, None, saved, now) == saved and state.start_position(None, None, None, now) == now
    with pytest.raises(ValueError, match="both"):
        state.start_position("f", None, saved, now)


class Service:
    def __init__(self, fail_at=None):
        self.calls, self.fail_at, self.most = [], fail_at, 0
        self.open = set()

    def __call__(self, method, path, body):
        if method == "POST":
            self.calls.append((path, body))
            self.open.add(len(self.calls))
            self.most = max(self.most, len(self.open))
            return {"taskUid": len(self.calls)}
        n = int(path.rsplit("/", 1)[1])
        self.open.discard(n)
        return {"status": "failed", "error": {"code": "missing_document_id", "message": "secret@example.net"}} if n == self.fail_at else {"status": "succeeded"}


def test_sink_keeps_order_bounds_what_is_in_flight_and_hides_payloads(spark, sf_dir):
    from strandflow.operators import batches

    numbered = batches.runs(catalog._ops(spark, sf_dir), 50)
    service = Service()
    n = SearchSink(service, max_in_flight=3).write(in_order(numbered))
    assert n == numbered.select("index", "batch_no").distinct().count() == len(service.calls) and service.most == 3
    assert sum(len(b) for _, b in service.calls) == numbered.count()
    with pytest.raises(SinkError) as error:
        SearchSink(Service(fail_at=2), max_in_flight=1).write([("i", "upsert", "id", [{"id": k, "mail": "secret@example.net"}]) for k in range(3)])
    assert "missing_document_id" in str(error.value) and "secret" not in str(error.value) and error.value.__cause__ is None

    def broken(method, path, body):
        raise ConnectionError("http://host/?key=secret")

    with pytest.raises(SinkError) as error:
        SearchSink(broken).submit("i", "upsert", "id", [{}])
    assert "secret" not in str(error.value)
    ticks = iter(range(0, 10_000, 100))
    with pytest.raises(SinkError, match="longer"):
        SearchSink(lambda m, p, b: {"taskUid": 1, "status": "processing"}, max_in_flight=1, sleep=lambda s: None, clock=lambda: next(ticks)).submit("i", "upsert", "id", [{}])


def test_metrics(spark):
    with pytest.raises(ValueError):
        metrics.RunMetrics("other")
    m = metrics.RunMetrics("full")
    with m.stage("read"):
        pass
    report = m.report()
    assert report["average_batch_size"] == 0.0 and "read" in report["stage_ms"] and report["peak_memory_mb"] > 0
    r = spark.range(1).select(metrics.ratio(F.lit(1), F.lit(0)).alias("z"), metrics.ratio(F.lit(1), F.lit(4)).alias("q")).first()
    assert tuple(r) == (0.0, 0.25)


def test_plan_with_a_filter_rereads_in_the_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 9), (2, "b", 1)], "id long, name string, stock int")
    plan = bind(TableSpec("t", "t", "id", ("id", "name"), "d", where_clause="stock > 5"), rows)
    row = F.struct("id", "name", "stock")
    e = rows.select(F.col("id").alias("seq"), F.lit("f").alias("file"), F.col("id").alias("pos"), F.lit("rows").alias("kind"), F.lit("d").alias("database"), F.lit("t").alias("table"), F.lit(0).alias("row_no"), F.lit(None).cast("struct<id:long,name:string,stock:int>").alias("before"), row.alias("after"))
    write(e.selectExpr("*", *SIDES), tmp_path, 0)
    store = IndexStore(spark, str(tmp_path / "i"))
    store.prepare([plan])
    pipeline.start(stream(spark, tmp_path), store, [plan], str(tmp_path / "cp")).awaitTermination()
    assert {r.document_id: r.op for r in store.state("t").collect()} == {"1": "upsert", "2": "delete"}
