import http.server
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from strandflow import catalog, cli
from strandflow.sources import index_store, state, tables
from strandflow.sources.files import Files
from strandflow.sources.index_store import IndexStore
from strandflow.sources.state import Position
from strandflow.sources.tables import image_type
from tests.test_spec import GOOD


def arguments(tmp_path, *command):
    return ["--config", str(tmp_path / "c.toml"), "--tables", str(tmp_path), "--changes", str(tmp_path / "changes"), "--store", str(tmp_path / "store"), *command]


def test_bad_config_is_told_before_anything_runs(tmp_path, capsys):
    (tmp_path / "c.toml").write_text(GOOD.replace("server_id = 7", "server_id = 0"))
    assert cli.main(arguments(tmp_path, "run")) == 1
    assert "server_id" in capsys.readouterr().err


def test_run_snapshot_then_changes_then_resume(spark, sf_dir, tmp_path, capsys):
    config = GOOD.replace('table = "products"\nindex = "products"\nprimary_key = "id"\nfields = ["id", "name"]', 'table = "users"\nindex = "users"\nprimary_key = "user_id"\nfields = ["user_id", "event_type"]')
    (tmp_path / "c.toml").write_text(config.replace("[search]", f'[runtime]\nstate_path = "{tmp_path}/state.json"\n[search]'))
    users = catalog.table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    users.groupBy("user_id").agg(F.max("event_type").alias("event_type"), F.max("props").alias("props")).write.parquet(str(tmp_path / "users.parquet"))
    row = spark.read.parquet(str(tmp_path / "users.parquet")).schema
    log = catalog._log(spark, sf_dir)
    log.select(*image_type(row).names).coalesce(1).write.parquet(str(tmp_path / "changes/users"))
    assert cli.main(arguments(tmp_path, "position")) == 0
    assert capsys.readouterr().out.strip().endswith("bin.000001:99904")
    assert cli.execute(spark, cli.parser().parse_args(arguments(tmp_path, "run")))["documents_indexed"] > 0
    state = IndexStore(spark, str(tmp_path / "store")).state("users")
    touched = {(r.document_id, r.event_type) for r in catalog.apply_last_write_wins(spark, sf_dir).collect()}
    assert touched == {(r.document_id, r.document.event_type) for r in state.where("op = 'upsert'").collect()}
    again = cli.execute(spark, cli.parser().parse_args(arguments(tmp_path, "cdc")))
    assert again["documents_indexed"] == 0


def users_pipeline(spark, sf_dir, tmp_path, search=""):
    """The users of the events, their changes, and a state file; returns the changes and the folder of transaction marks."""
    config = GOOD.replace('table = "products"\nindex = "products"\nprimary_key = "id"\nfields = ["id", "name"]', 'table = "users"\nindex = "users"\nprimary_key = "user_id"\nfields = ["user_id", "event_type"]')
    config = config.replace('host = "http://localhost:7700"', search or 'host = "http://localhost:7700"')
    (tmp_path / "c.toml").write_text(config.replace("[search]", f'[runtime]\nstate_path = "{tmp_path}/state.json"\nflush_interval_ms = 200\n[search]'))
    users = catalog.table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    users.groupBy("user_id").agg(F.max("event_type").alias("event_type"), F.max("props").alias("props")).write.parquet(str(tmp_path / "users.parquet"))
    row = spark.read.parquet(str(tmp_path / "users.parquet")).schema
    return catalog._log(spark, sf_dir).select(*image_type(row).names), str(tmp_path / "changes")


def marks(spark, *rows):
    return spark.createDataFrame([(s, "bin.000001", p, k, q) for s, p, k, q in rows], "seq long, file string, pos long, kind string, query string").selectExpr("*", "CAST(NULL AS string) AS rotate_file", "CAST(NULL AS long) AS rotate_pos").coalesce(1)


def run(spark, tmp_path, *command):
    return cli.execute(spark, cli.parser().parse_args(arguments(tmp_path, *command)))


def test_saved_position_is_the_last_one_with_nothing_open(spark, sf_dir, tmp_path, monkeypatch):
    log, changes = users_pipeline(spark, sf_dir, tmp_path)
    log.where("seq < 500").coalesce(1).write.parquet(f"{changes}/users")
    marks(spark, (300, 30_010, "xid", None)).write.parquet(f"{changes}/transactions")
    run(spark, tmp_path, "run")
    assert state.load(tmp_path / "state.json") == Position("bin.000001", 30_010)  # what follows 300 is open
    log.where("seq >= 500 AND seq < 700").coalesce(1).write.mode("append").parquet(f"{changes}/users")
    marks(spark, (600, 60_005, "query", "SAVEPOINT s")).write.mode("append").parquet(f"{changes}/transactions")
    run(spark, tmp_path, "cdc")
    assert state.load(tmp_path / "state.json") == Position("bin.000001", 30_010)  # still open from the run before
    log.where("seq >= 700").coalesce(1).write.mode("append").parquet(f"{changes}/users")
    marks(spark, (2000, 200_000, "query", " commit; ")).write.mode("append").parquet(f"{changes}/transactions")

    def killed(*_):
        raise OSError("killed between apply and save")

    with monkeypatch.context() as m, pytest.raises(Exception, match="killed"):
        m.setattr(cli.state, "save", killed)
        run(spark, tmp_path, "cdc")
    assert state.load(tmp_path / "state.json") == Position("bin.000001", 30_010)  # applied, not saved
    run(spark, tmp_path, "cdc")
    assert state.load(tmp_path / "state.json") == Position("bin.000001", 200_000)
    want = {(r.document_id, r.event_type) for r in catalog.apply_last_write_wins(spark, sf_dir).collect()}
    assert want == {(r.document_id, r.document.event_type) for r in IndexStore(spark, str(tmp_path / "store")).state("users").where("op = 'upsert'").collect()}


def test_follow_goes_on_until_it_is_told_to_stop(spark, sf_dir, tmp_path):
    log, changes = users_pipeline(spark, sf_dir, tmp_path)
    log.where("seq < 100").coalesce(1).write.parquet(f"{changes}/users")
    marks(spark, (100, 10_500, "xid", None)).write.parquet(f"{changes}/transactions")
    stop = threading.Event()
    reports = []
    args = cli.parser().parse_args(arguments(tmp_path, "cdc", "--file", "bin.000001", "--pos", "4", "--follow"))
    t = threading.Thread(target=lambda: reports.append(cli.execute(spark, args, stop)))
    t.start()
    until = time.monotonic() + 60
    while state.load(tmp_path / "state.json") != Position("bin.000001", 10_500) and time.monotonic() < until:
        time.sleep(0.2)
    log.where("seq >= 100").coalesce(1).write.mode("append").parquet(f"{changes}/users")
    marks(spark, (3000, 300_000, "xid", None)).write.mode("append").parquet(f"{changes}/transactions")
    while state.load(tmp_path / "state.json") != Position("bin.000001", 300_000) and time.monotonic() < until:
        time.sleep(0.2)
    stop.set()
    t.join(60)
    assert state.load(tmp_path / "state.json") == Position("bin.000001", 300_000)
    assert reports[0]["status"] == "succeeded" and reports[0]["peak_rss_mb"] > 0 and {"transform", "apply", "checkpoint_write"} <= set(reports[0]["stage_ms"])


class Service(http.server.BaseHTTPRequestHandler):
    """A search service in memory, for one test at a time."""

    indexes: dict = {}
    settings: dict = {}
    sizes: list = []
    keys: set = set()

    def reply(self, code, body):
        data = json.dumps(body).encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def handle_one(self, method):
        body = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)) or b"null")
        path, _, ask = self.path.partition("?")
        self.keys.add(self.headers.get("Authorization"))
        _, kind, *rest = path.split("/")
        if kind == "tasks":
            return self.reply(200, {"status": "succeeded"})
        if method == "GET":
            return self.reply(200 if rest[0] in self.indexes else 404, {})
        if not rest:
            self.indexes[body["uid"]] = {}
        elif method == "PATCH":
            self.settings[rest[0]] = body
        elif rest[-1] == "delete-batch":
            for key in body:
                self.indexes[rest[0]].pop(key, None)
            self.sizes.append(len(body))
        elif method == "POST":
            for document in body:
                self.indexes[rest[0]][str(document[ask.partition("=")[2]])] = document
            self.sizes.append(len(body))
        elif method == "DELETE":
            self.indexes[rest[0]] = {} if rest[-1] == "documents" else self.indexes.pop(rest[0])
        self.reply(202, {"taskUid": 1})

    def do_GET(self):
        self.handle_one("GET")

    def do_POST(self):
        self.handle_one("POST")

    def do_PATCH(self):
        self.handle_one("PATCH")

    def do_DELETE(self):
        self.handle_one("DELETE")

    def log_message(self, *_):
        pass


def test_run_against_a_service(spark, sf_dir, tmp_path, monkeypatch):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("STRANDFLOW_SEARCH_API_KEY", "k")
    log, changes = users_pipeline(spark, sf_dir, tmp_path, f'host = "http://127.0.0.1:{server.server_port}"\nbatch_size = 40\nmax_in_flight_tasks = 2')
    log.coalesce(1).write.parquet(f"{changes}/users")
    report = run(spark, tmp_path, "--sink", "http", "run")
    server.shutdown()
    want = {(r.document_id, r.event_type) for r in catalog.apply_last_write_wins(spark, sf_dir).collect()}
    assert {(k, d["event_type"]) for k, d in Service.indexes["users"].items()} == want
    assert max(Service.sizes) <= 40 and Service.keys == {"Bearer k"} and Service.settings["users"] == {"displayedAttributes": ["user_id", "event_type"]}
    assert report["documents_indexed"] > 0 and {"http", "task_wait"} <= set(report["stage_ms"])


def test_tables_of_one_name_are_told_apart_by_database(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    (tmp_path / "a" / "t").mkdir(parents=True)
    assert tables.place(files, "a", "t", [("a", "t"), ("b", "t")]).endswith("/a/t")
    assert tables.place(files, "a", "u", [("a", "u")]).endswith("/u")
    with pytest.raises(ValueError, match="b/t"):
        tables.place(files, "b", "t", [("a", "t"), ("b", "t")])


def test_positions_of_files_without_a_number(spark):
    log = spark.createDataFrame([(1, "first", 9), (2, "bin.9", 1), (3, "bin.10", 0)], "seq long, file string, pos long")
    assert tuple(tables.last_position(log).first()) == ("bin.10", 0)
    assert [r.seq for r in tables.from_position(log, "bin.9", 1).orderBy("seq").collect()] == [2, 3]


def test_index_store_appends_and_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "COMPACT", 3)
    monkeypatch.setattr(index_store, "GRACE", 0)
    store = IndexStore(spark, str(tmp_path))
    want = {}
    for k in range(8):
        rows = [("i", str(n), "upsert" if (n + k) % 4 else "delete", (n, f"v{k}"), k, 0, 1) for n in range(k, k + 5)]
        want |= {r[1]: (r[2], r[3][1]) for r in rows}
        ops = spark.createDataFrame(rows, "index string, document_id string, op string, document struct<id:int,v:string>, seq long, row_no int, sub_no int")
        store.apply("i", ops, str(k))
        store.apply("i", ops, str(k))  # done again
        assert {r.document_id: (r.op, r.document.v) for r in store.state("i").collect()} == want
    assert len(store._read("i")["appended"]) == 2 and store._read("i")["version"] == "v-5"
    assert {r.document_id for r in store.documents("i").collect()} == {k for k, (op, _) in want.items() if op == "upsert"}
