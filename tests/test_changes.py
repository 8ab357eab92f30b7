import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandflow.functions import values
from strandflow.operators import apply, batches, changes, positions, ranges, reread, snapshot
from strandflow.operators.ranges import last_known, number, ordered, previous, running_sum
from strandflow.plans.plan import bind, bind_all, column_of, quoted, route
from strandflow.sources.tables import image_type, routed_or_fail
from strandflow.spec import SpecError, TableSpec

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("stock", T.IntegerType()), T.StructField("deleted_at", T.StringType())])
SPEC = TableSpec("products", "products", "id", ("id", "name"), "shop")


def plan(spark, rows=(), **more):
    spec = TableSpec(**({"table": "products", "index": "products", "primary_key": "id", "fields": ("id", "name"), "database": "shop"} | more))
    return bind(spec, spark.createDataFrame(list(rows), ROW))


def image(**values):
    return (tuple(values.get(f.name) for f in ROW), list(values)) if values else (None, None)


def events(spark, *pairs):
    """Events of (before, after) images, each a dict or None, with the columns that they name present."""
    rows = []
    for n, (b, a) in enumerate(pairs):
        (b, bp), (a, ap) = image(**(b or {})), image(**(a or {}))
        rows.append((n, "bin.000001", 100 + n, "rows", "shop", "products", 0, b, a, bp, None, ap, None))
    fields = image_type(ROW)
    return spark.createDataFrame(rows, T.StructType([*fields[:9], fields["before_present"], fields["before_unknown"], fields["after_present"], fields["after_unknown"]]))


def one(spark, before, after, **more):
    return changes.derived(events(spark, (before, after)), plan(spark, **more)).first()


def test_minimal_update_takes_the_key_from_before_and_rereads(spark):
    r = one(spark, {"id": 42}, {"name": "updated"})
    assert (r.kind, r.pk, r.needs_fetch, r.previous_id, r.document_id) == ("upsert", 42, True, "42", "42")


def test_changed_key_prefers_after(spark):
    r = one(spark, {"id": 42, "name": "a"}, {"id": 43, "name": "a"})
    assert (r.pk, r.previous_id, r.needs_fetch) == (43, "42", False)
    ops = changes.operations(events(spark, ({"id": 42, "name": "a"}, {"id": 43, "name": "a"})), plan(spark)).orderBy("sub_no").collect()
    assert [(o.op, o.document_id, o.sub_no) for o in ops] == [("delete", "42", 0), ("upsert", "43", 1)]


@pytest.mark.parametrize("before, after, more, kind", [
    ({"id": 1}, {"stock": 4}, {}, "ignored"),
    ({"id": 1, "name": "a"}, {"id": 1, "name": "b"}, {}, "upsert"),
    ({"id": 1, "name": None}, {"id": 1, "name": None}, {}, "ignored"),
    ({"id": 1}, {"deleted_at": "x"}, {"watch_fields": ("deleted_at",)}, "upsert"),
    ({"id": 1}, {"deleted_at": "x"}, {}, "ignored"),
    (None, {"id": 1, "name": "a"}, {}, "upsert"),
    ({"id": 1}, None, {"where_clause": "stock > 5"}, "delete"),
    (None, None, {}, "ignored"),
])
def test_truth_table(spark, before, after, more, kind):
    assert one(spark, before, after, **more).kind == kind


def test_null_is_known_and_a_filter_always_rereads(spark):
    assert not one(spark, None, {"id": 1, "name": None}).needs_fetch
    assert one(spark, None, {"id": 1, "name": "a"}, where_clause="stock > 5").needs_fetch


@pytest.mark.parametrize("before, after", [(None, {"name": "a"}), ({"name": "a"}, None), ({"name": "a"}, {"name": "b"})])
def test_missing_key_is_an_error(spark, before, after):
    with pytest.raises(Exception, match="no id in an image"):
        one(spark, before, after)


def test_unknown_value_forces_a_reread(spark):
    e = events(spark, ({"id": 1, "name": "a"}, {"id": 1, "name": "a"})).withColumn("after_unknown", F.array(F.lit("name")))
    r = changes.derived(e, plan(spark)).first()
    assert (r.kind, r.needs_fetch) == ("upsert", True)


def test_reread_finds_misses_and_obeys_the_filter(spark):
    p = plan(spark, [(1, "now", 9, None), (2, "low", 1, None)], where_clause="stock > 5")
    ops = changes.operations(events(spark, *[(None, {"id": k, "name": "then"}) for k in (1, 2, 3)]), p)
    got = {o.document_id: (o.op, o.document and o.document.name) for o in reread.resolved(ops, p).collect()}
    assert got == {"1": ("upsert", "now"), "2": ("delete", None), "3": ("delete", None)}


def test_routes(spark):
    p = [plan(spark), plan(spark, index="public"), plan(spark, database="other")]
    e = spark.createDataFrame([("shop", "products"), ("shop", "Products"), ("none", "products")], "database string, table string")
    assert sorted(r["index"] for r in route(e, p).collect()) == ["products", "public"]
    with pytest.raises(Exception, match="no table map"):
        routed_or_fail(spark.createDataFrame([("rows", None, "f", 4)], "kind string, table string, file string, pos long")).collect()


def test_columns():
    assert column_of("@1", ["id", "title"]) == "title" and column_of("id", []) == "id"
    assert quoted("a`b") == "`a``b`"
    for raw in ("@2", "@x"):
        with pytest.raises(SpecError):
            column_of(raw, ["id", "title"])


def test_binding_needs_its_columns_and_sources(spark):
    with pytest.raises(SpecError, match="no column 'nope'"):
        plan(spark, watch_fields=("nope",))
    with pytest.raises(SpecError, match="no source for shop.products"):
        bind_all((SPEC,), {})


def fold_batches(ops, size):
    """The sink's buffer, one operation after the other: epochs of ``size``, cut where the kind changes."""
    out, no = [], 0
    for n, op in enumerate(ops):
        if n % size == 0 or ops[n - 1] != op:
            no += 1
        out.append(no)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_batches_equal_a_sequential_fold(spark, seed):
    rnd = random.Random(seed)
    size, logs = rnd.randint(1, 6), {i: [rnd.choice(["upsert", "delete"]) for _ in range(rnd.randint(1, 80))] for i in ("a", "b")}
    rows = [Row(index=i, op=op, seq=n, row_no=0, sub_no=0, event_id=str(n // 2)) for i, ops in logs.items() for n, op in enumerate(ops)]
    df = spark.createDataFrame(rows)
    got = batches.runs(df, size).collect()
    for i, ops in logs.items():
        assert [r.batch_no for r in sorted((r for r in got if r["index"] == i), key=lambda r: r.seq)] == fold_batches(ops, size)
    for r in batches.batches(df, size).collect():
        assert r.n_ops <= size and r.event_ids == sorted(set(r.event_ids), key=int)


def test_last_write_wins_and_replay_changes_nothing(spark):
    ops = [("users", str(k % 3), "delete" if k % 4 == 3 else "upsert", None if k % 4 == 3 else (k,), k, 0, 1) for k in range(30)]
    kind = "index string, document_id string, op string, document struct<v:long>, seq long, row_no int, sub_no int"
    df = spark.createDataFrame(ops, kind)
    state = apply.last_operations(df)
    want = {}
    for o in ops:
        want[o[1]] = o[3] and o[3][0]
    assert {r.document_id: r.document and r.document.v for r in state.collect()} == want
    assert sorted(apply.merged(state, df.where("seq > 12")).collect()) == sorted(state.collect())
    assert apply.live(state).count() == sum(v is not None for v in want.values())
    assert apply.last_operations(df.limit(0)).count() == 0


def fold_positions(log):
    file, pos, safe, open_, packed = "bin.1", 4, ("bin.1", 4), False, False
    for kind, query, log_pos, rotate_file, rotate_pos in log:
        if log_pos and not packed and kind != "rotate":
            pos = log_pos
        text = (query or "").strip().rstrip("; ").upper()
        if kind == "rotate":
            file, pos = rotate_file, rotate_pos
        if kind == "xid" or kind == "query" and text in ("COMMIT", "ROLLBACK"):
            open_, packed, safe = False, False, (file, pos)
        elif kind == "query" and text == "BEGIN":
            open_ = True
        elif kind in ("query", "rotate"):
            if not open_:
                safe = (file, pos)
        elif kind in positions.OPENERS:
            open_ = True
            packed = packed or kind == "transaction_payload"
        yield file, pos, *safe


@pytest.mark.parametrize("seed", range(3))
def test_safe_positions_equal_a_fold(spark, seed):
    rnd = random.Random(seed)
    kinds = ["xid", "query", "query", "table_map", "rows", "gtid", "anonymous_gtid", "transaction_payload", "rotate", "heartbeat"]
    log = []
    for n in range(150):
        kind = rnd.choice(kinds)
        log.append((kind, rnd.choice(["BEGIN", "commit;", " rollback ; ", "SAVEPOINT s", "CREATE TABLE t"]) if kind == "query" else None, rnd.choice([0, 10 * n + 5]), f"bin.{n}" if kind == "rotate" else None, 4 if kind == "rotate" else None))
    df = spark.createDataFrame([(n, *e) for n, e in enumerate(log)], "seq long, kind string, query string, log_pos long, rotate_file string, rotate_pos long")
    got = [(r.current_file, r.current_pos, r.safe_file, r.safe_pos) for r in positions.safe_positions(df, "bin.1", 4).orderBy("seq").collect()]
    assert got == list(fold_positions(log))


def test_scans_in_ranges_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(ranges, "SAMPLE", 60)
    rnd = random.Random(5)
    rows = [(g, n, rnd.choice([None, rnd.randint(0, 9)])) for g in "ab" for n in rnd.sample(range(1000), 120)]
    df = spark.createDataFrame(rows, "g string, n long, v long")
    o = ordered(df, "n", by=("g",), ranges=7).scan(k=number(), p=previous("v"), s=running_sum("v"), l=last_known("v"), b=last_known("v", False)).done()
    for g in "ab":
        mine = sorted(r for r in o.collect() if r.g == g)
        mine.sort(key=lambda r: r.n)
        total, last = 0, None
        for i, r in enumerate(mine):
            assert (r.k, r.p, r.b) == (i + 1, mine[i - 1].v if i else None, last)
            total, last = total + (r.v or 0), r.v if r.v is not None else last
            assert (r.s, r.l) == (total, last)
    assert ordered(df.limit(0), "n").scan(k=number()).done().count() == 0


def test_images_by_place_and_quoted_fields(spark):
    source = spark.createDataFrame([(1, "a", "x")], "id long, `a.b` string, other string")
    spec = TableSpec("t", "t", "id", ("id", "a.b"), "d", field_aliases={"a.b": "ab"})
    p = bind(spec, source)
    assert [tuple(r) for r in snapshot.documents(p).collect()] == [(1, "a")] and snapshot.lookup(p, 1).first().ab == "a"
    kind = "seq long, file string, pos long, row_no int, before struct<`@0`:long,`@1`:string,`@2`:string>, after struct<`@0`:long,`@1`:string,`@2`:string>, before_present array<string>, before_unknown array<string>, after_present array<string>, after_unknown array<string>"
    rows = [(1, "f", 1, 0, (7, "a", "x"), (7, "a", "y"), None, None, None, None), (2, "f", 2, 0, (7, "a", "x"), (7, "b", "x"), None, None, None, None), (3, "f", 3, 0, (8, None, None), (None, "c", None), ["@0"], None, ["@1"], None)]
    got = {r.seq: r for r in changes.derived(spark.createDataFrame(rows, kind), p).collect()}
    assert [got[k].kind for k in (1, 2, 3)] == ["ignored", "upsert", "upsert"] and got[2].document.ab == "b" and got[3].document_id == "8" and got[3].needs_fetch
    assert values.logged_id({"id": "x"}, "id") == '"x"' and values.logged_id({"id": 4}, "id") == "4" and values.logged_id({}, "id") == "<missing>"
