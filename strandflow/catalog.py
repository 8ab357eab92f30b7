"""The queries of the change-data engine and their SQL.

The change log is derived from the events table: the key is the user, the document (user_id, event_type); an error
deletes, a signup or a user's first event inserts, any other event updates the user's event before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandflow.functions import values
from strandflow.operators import apply, batches, changes, metrics, positions, reread, snapshot
from strandflow.plans.plan import TablePlan, bind, column_of, quoted, route
from strandflow.session import shared_folder, table
from strandflow.sources import tables
from strandflow.sources.files import Files
from strandflow.sources.index_store import IndexStore
from strandflow.sources.state import Position
from strandflow.spec import TableSpec
from strandflow.streaming import pipeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

DATABASE = "shop"
BATCH = 50
PAGE = 1000
ORDERS = TableSpec("orders", "orders", "o_orderkey", ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"), DATABASE, field_aliases={"o_orderkey": "id", "o_totalprice": "total", "o_orderdate": "ordered_at"})
URGENT = TableSpec("orders", "urgent_orders", "o_orderkey", ("o_orderkey", "o_orderpriority"), DATABASE, where_clause="o_orderpriority = '1-URGENT'", field_aliases={"o_orderkey": "id"})
CUSTOMERS = TableSpec("customer", "parties", "c_custkey", ("c_custkey", "c_name"), DATABASE, field_aliases={"c_custkey": "key", "c_name": "name"})
SUPPLIERS = TableSpec("supplier", "parties", "s_suppkey", ("s_suppkey", "s_name"), DATABASE, field_aliases={"s_suppkey": "key", "s_name": "name"})
USERS = TableSpec("users", "users", "user_id", ("user_id", "event_type"), DATABASE)
WATCHED = TableSpec("users", "users", "user_id", ("user_id", "event_type"), DATABASE, watch_fields=("props",))
#: Rich customers by their key under the name that events use: rereads of others miss.
RICH = TableSpec("customer", "users", "user_id", ("user_id", "c_name"), DATABASE, where_clause="c_acctbal > 0")


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _orders(spark: SparkSession, sf_dir: str, spec: TableSpec = ORDERS) -> TablePlan:
    return bind(spec, table(spark, sf_dir, "orders"))


def change_log(events: DataFrame) -> DataFrame:
    """The events as changes with full row images, ordered by seq."""
    row = F.struct("user_id", "event_type", "props")
    before = F.lag(row).over(Window.partitionBy("user_id").orderBy("event_id"))
    gone = F.col("event_type") == "error"
    fresh = ~gone & ((F.col("event_type") == "signup") | before.isNull())
    return events.select(
        F.col("event_id").alias("seq"), F.lit("bin.000001").alias("file"), (F.col("event_id") * 100 + 4).alias("pos"), F.lit("rows").alias("kind"),
        F.lit(DATABASE).alias("database"), F.lit("users").alias("table"), F.lit(0).alias("row_no"),
        F.when(gone, row).when(~fresh, before).alias("before"), F.when(~gone, row).alias("after"),
        *[F.lit(None).cast("array<string>").alias(f"{s}_{n}") for s in ("before", "after") for n in ("present", "unknown")],
        F.lit(None).cast("string").alias("query"), F.lit(None).cast("string").alias("rotate_file"), F.lit(None).cast("long").alias("rotate_pos"),
    )


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props"))


def _users(spark: SparkSession, sf_dir: str, spec: TableSpec = USERS) -> TablePlan:
    return bind(spec, table(spark, sf_dir, "events").select("user_id", "event_type", "props"))


def _ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.operations(_log(spark, sf_dir), _users(spark, sf_dir))


#: The change log and its operations in DuckDB, for queries over them.
_LOG_SQL = """
log AS (SELECT event_id AS seq, user_id, event_type, props, lag(event_type) OVER w AS prev_type, lag(props) OVER w AS prev_props, lag(event_id) OVER w AS prev_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
derived AS (SELECT *, CASE WHEN event_type = 'error' THEN 'delete' WHEN event_type = 'signup' OR prev_id IS NULL THEN 'upsert' WHEN event_type IS DISTINCT FROM prev_type THEN 'upsert' ELSE 'ignored' END AS kind FROM log),
ops AS (SELECT 'users' AS "index", CAST(user_id AS VARCHAR) AS document_id, kind AS op, CASE WHEN kind = 'upsert' THEN event_type END AS event_type, seq FROM derived WHERE kind <> 'ignored')
"""


@query("SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice AS total, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ordered_at FROM orders")
def snapshot_project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.documents(_orders(spark, sf_dir))


@query("SELECT o_orderkey AS id, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'")
def snapshot_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.documents(_orders(spark, sf_dir, URGENT))


@query(f"SELECT o_orderkey AS id, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderkey LIMIT {PAGE}")
def keyset_first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.page(_orders(spark, sf_dir, URGENT), size=PAGE)


@query(f"SELECT o_orderkey AS id, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey > 500 ORDER BY o_orderkey LIMIT {PAGE}")
def keyset_next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.page(_orders(spark, sf_dir, URGENT), after=500, size=PAGE)


def _parts_sql(size: int) -> str:
    return f"SELECT CAST((n - 1) // {size} AS BIGINT) AS part, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) GROUP BY 1"


@query(_parts_sql(PAGE))
def keyset_page_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.parts(_orders(spark, sf_dir), PAGE)


@query(_parts_sql(700))
def snapshot_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.parts(_orders(spark, sf_dir), 700)


@query("SELECT c_custkey AS key, c_name AS name FROM customer WHERE c_custkey = 42")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.lookup(bind(CUSTOMERS, table(spark, sf_dir, "customer")), 42)


@query("""
SELECT event_id AS id, CASE WHEN extract('microsecond' FROM ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS text FROM events
UNION ALL SELECT -o_orderkey - 1, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') FROM orders""")
def doc_datetime_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), values.format_datetime(F.col("ts")).alias("text"))
    return events.unionByName(table(spark, sf_dir, "orders").select((-F.col("o_orderkey") - 1).alias("id"), values.format_datetime(F.col("o_orderdate")).alias("text")))


@query("""
WITH t AS (SELECT event_id, (event_id * 7919 - 20000000) * CASE WHEN event_id % 3 = 0 THEN 1000000 ELSE 1000001 END AS us FROM events)
SELECT event_id, CASE WHEN us < 0 THEN '-' ELSE '' END || printf('%02d:%02d:%02d', abs(us) // 3600000000, abs(us) // 60000000 % 60, abs(us) // 1000000 % 60) || CASE WHEN abs(us) % 1000000 = 0 THEN '' ELSE printf('.%06d', abs(us) % 1000000) END AS text FROM t""")
def doc_time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = (F.col("event_id") * 7919 - 20_000_000) * F.when(F.col("event_id") % 3 == 0, 1_000_000).otherwise(1_000_001)
    part = lambda n: (micros.cast("decimal(30,0)") / 1).cast("long") if n else micros
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (part(1).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))
    return table(spark, sf_dir, "events").select("event_id", values.format_time(second).alias("text"))


@query("""
SELECT 'customer' AS of, CAST(c_custkey AS VARCHAR) AS document_id FROM customer
UNION ALL SELECT 'event', coalesce(CAST(nullif(user_id, 7) AS VARCHAR), '') FROM events
UNION ALL SELECT 'price', CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) FROM part""")
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    def ids(of: str, df: DataFrame, col: Column) -> DataFrame:
        df = df.select(col.alias("v"))
        return df.select(F.lit(of).alias("of"), values.document_id(F.col("v"), df.schema["v"].dataType).alias("document_id"))

    parts = [
        ids("customer", table(spark, sf_dir, "customer"), F.col("c_custkey")),
        ids("event", table(spark, sf_dir, "events"), F.nullif("user_id", F.lit(7))),
        ids("price", table(spark, sf_dir, "part"), F.floor("p_retailprice").cast("double")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[2] AS DOUBLE) AS second FROM embeddings")
def float_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).alias("a"), F.get("embedding", F.lit(1)).alias("b"))
    kind = cells.schema["a"].dataType
    return cells.select("vec_id", values.document_value(F.col("a"), kind).alias("first"), values.document_value(F.col("b"), kind).alias("second"))


@query("""
SELECT 'orders' AS "index", 'id' AS pk_field, CAST(o_orderkey AS VARCHAR) AS document_id FROM orders
UNION ALL SELECT 'urgent_orders', 'id', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT'""")
def fanout_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans = [_orders(spark, sf_dir), _orders(spark, sf_dir, URGENT)]
    return reduce(DataFrame.unionByName, (snapshot.keyed_documents(p).select("index", "pk_field", "document_id") for p in plans))


@query("""
SELECT 'parties' AS "index", CAST(c_custkey AS VARCHAR) AS document_id, '{"key":' || c_custkey || ',"name":"' || c_name || '"}' AS document FROM customer
UNION ALL SELECT 'parties', CAST(s_suppkey AS VARCHAR), '{"key":' || s_suppkey || ',"name":"' || s_name || '"}' FROM supplier""")
def merge_sources_one_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.merged([bind(CUSTOMERS, table(spark, sf_dir, "customer")), bind(SUPPLIERS, table(spark, sf_dir, "supplier"))])


@query(f"""
WITH {_LOG_SQL}
SELECT seq, CASE WHEN event_type = 'error' THEN user_id WHEN event_type = 'signup' OR prev_id IS NULL THEN NULL ELSE user_id END AS before_user,
CASE WHEN event_type = 'error' THEN event_type WHEN event_type = 'signup' THEN NULL ELSE prev_type END AS before_type,
CASE WHEN event_type <> 'error' THEN user_id END AS after_user, CASE WHEN event_type <> 'error' THEN event_type END AS after_type FROM log""")
def row_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return log.select("seq", F.col("before.user_id").alias("before_user"), F.col("before.event_type").alias("before_type"), F.col("after.user_id").alias("after_user"), F.col("after.event_type").alias("after_type"))


@query(f"WITH {_LOG_SQL} SELECT \"index\", document_id, op, event_type, seq, 'bin.000001:' || (seq * 100 + 4) AS event_id FROM ops")
def derive_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ops(spark, sf_dir).select("index", "document_id", "op", F.col("document.event_type").alias("event_type"), "seq", "event_id")


@query(f"""
WITH {_LOG_SQL} SELECT seq, kind = 'ignored' AS ignored, kind = 'ignored' AND props IS NOT DISTINCT FROM prev_props AS ignored_watched FROM derived""")
def change_filter_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    plain = changes.derived(log, _users(spark, sf_dir)).select("seq", (F.col("kind") == "ignored").alias("ignored"))
    watched = changes.derived(log, _users(spark, sf_dir, WATCHED)).select(F.col("seq").alias("s"), (F.col("kind") == "ignored").alias("ignored_watched"))
    return plain.join(watched, F.col("seq") == F.col("s")).drop("s")


def _minimal(log: DataFrame) -> DataFrame:
    """Updates with the key only before, and only what isn't the key after; of every fifth the value is unknown."""
    update = F.col("before").isNotNull() & F.col("after").isNotNull()
    blank = F.struct(F.lit(None).cast("bigint").alias("user_id"), F.col("after.event_type"), F.col("after.props"))
    key_only = F.struct(F.col("before.user_id"), F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("string").alias("props"))
    names = lambda *n: F.array(*[F.lit(x) for x in n])
    new = {
        "before_present": F.when(update, names("user_id")), "after_present": F.when(update, names("event_type", "props")),
        "after_unknown": F.when(update & (F.col("seq") % 5 == 0), names("event_type")),
        "before": F.when(update, key_only).otherwise(F.col("before")), "after": F.when(update, blank).otherwise(F.col("after")),
    }
    return log.select("*").withColumns({f"_{k}": v for k, v in new.items()}).drop(*new).withColumnsRenamed({f"_{k}": k for k in new})


@query(f"""
WITH {_LOG_SQL}
SELECT seq, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS kind, CAST(user_id AS VARCHAR) AS document_id,
CASE WHEN event_type NOT IN ('error', 'signup') AND prev_id IS NOT NULL THEN CAST(user_id AS VARCHAR) END AS previous_id,
event_type NOT IN ('error', 'signup') AND prev_id IS NOT NULL AS needs_fetch FROM log""")
def minimal_image_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.derived(_minimal(_log(spark, sf_dir)), _users(spark, sf_dir))
    return rows.select("seq", "kind", "document_id", "previous_id", "needs_fetch")


@query("""
SELECT o_orderkey AS seq, 0 AS sub_no, 'delete' AS op, CAST(o_orderkey AS VARCHAR) AS document_id, NULL AS status FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 1, 'upsert', CAST(o_orderkey + 10000000 AS VARCHAR), o_orderstatus FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 1, 'upsert', CAST(o_orderkey AS VARCHAR), 'X' FROM orders WHERE o_orderstatus = 'F'""")
def pk_change_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("orders", "orders", "o_orderkey", ("o_orderkey", "o_orderstatus"), DATABASE)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    status = F.col("o_orderstatus")
    after = F.struct((F.col("o_orderkey") + F.when(status == "P", 10_000_000).otherwise(0)).alias("o_orderkey"), F.when(status == "F", "X").otherwise(status).alias("o_orderstatus"))
    none = [F.lit(None).cast("array<string>").alias(f"{s}_{n}") for s in ("before", "after") for n in ("present", "unknown")]
    events = orders.select(F.col("o_orderkey").alias("seq"), F.lit("bin.000001").alias("file"), F.col("o_orderkey").alias("pos"), F.lit(0).alias("row_no"), F.struct("o_orderkey", "o_orderstatus").alias("before"), after.alias("after"), *none)
    return changes.operations(events, bind(spec, orders)).select("seq", "sub_no", "op", "document_id", F.col("document.o_orderstatus").alias("status"))


def _reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_acctbal")
    plan = bind(RICH, customers)
    row = lambda side: F.when(F.col(side).isNotNull(), F.struct(F.col(f"{side}.user_id"), F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("double").alias("c_acctbal")))
    known = F.array(F.lit("user_id"))
    log = _log(spark, sf_dir).withColumns({"before": row("before"), "after": row("after"), "before_present": known, "after_present": known})
    log = log.withColumn("after_unknown", F.array(F.lit("c_name"))).withColumn("after_present", F.array(F.lit("user_id"), F.lit("c_name")))
    return reread.resolved(changes.operations(log, plan), plan)


_REREAD_SQL = f"WITH {_LOG_SQL} SELECT seq, CAST(user_id AS VARCHAR) AS document_id, {{}} FROM log {{}} JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON user_id = c_custkey WHERE event_type <> 'error' {{}}"


@query(_REREAD_SQL.format("c_name AS name", "", ""))
def reread_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reread(spark, sf_dir).where("reread AND op = 'upsert'").select("seq", "document_id", F.col("document.c_name").alias("name"))


@query(_REREAD_SQL.format("'missing or excluded' AS reason", "LEFT", "AND c_custkey IS NULL"))
def reread_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reread(spark, sf_dir).where("reread AND op = 'delete'").select("seq", "document_id", "reason")


@query("""
WITH e AS (SELECT event_id AS seq, event_type AS "table" FROM events),
p("table", "index") AS (VALUES ('click', 'clicks'), ('click', 'all_events'), ('purchase', 'all_events'), ('view', 'views'))
SELECT seq, "table", "index" FROM e JOIN p USING ("table")""")
def route_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "events").select("event_id")
    named = [("click", "clicks"), ("click", "all_events"), ("purchase", "all_events"), ("view", "views")]
    plans = [bind(TableSpec(t, i, "event_id", ("event_id",), DATABASE), source) for t, i in named]
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.lit(DATABASE).alias("database"), F.col("event_type").alias("table"))
    return route(events, plans).select("seq", "table", "index")


_RUNS_SQL = f"""
{_LOG_SQL}, numbered AS (SELECT *, row_number() OVER (ORDER BY seq) AS n FROM ops),
marked AS (SELECT *, CASE WHEN lag(op) OVER (ORDER BY seq) = op {{}} THEN 0 ELSE 1 END AS starts FROM numbered),
runs AS (SELECT *, CAST(sum(starts) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS batch_no FROM marked)"""
_EPOCH = f"AND lag((n - 1) // {BATCH}) OVER (ORDER BY seq) = (n - 1) // {BATCH}"


@query("WITH " + _RUNS_SQL.format("") + 'SELECT "index", batch_no, min(op) AS op, count(*) AS n_ops, min(seq) AS first_seq, max(seq) AS last_seq FROM runs GROUP BY 1, 2')
def op_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = batches.runs(_ops(spark, sf_dir)).groupBy("index", "batch_no")
    return made.agg(F.min("op").alias("op"), F.count("*").alias("n_ops"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


@query("WITH " + _RUNS_SQL.format(_EPOCH) + 'SELECT "index", batch_no, min(op) AS op, count(*) AS n_ops, min(seq) AS first_seq, max(seq) AS last_seq FROM runs GROUP BY 1, 2')
def op_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batches(_ops(spark, sf_dir), BATCH).drop("event_ids")


def _two_rows(ops: DataFrame) -> DataFrame:
    """Two rows to an event: neighbours share the event of the even one."""
    return ops.withColumn("event_id", F.concat(F.lit("e"), (F.col("seq") - F.col("seq") % 2).cast("string")))


@query("WITH " + _RUNS_SQL.format(_EPOCH) + """SELECT "index", batch_no, count(DISTINCT seq - seq % 2) AS n_events, 'e' || min(seq - seq % 2) AS first_event FROM runs GROUP BY 1, 2""")
def batch_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = batches.batches(_two_rows(_ops(spark, sf_dir)), BATCH)
    return made.select("index", "batch_no", F.size("event_ids").cast("long").alias("n_events"), F.get("event_ids", F.lit(0)).alias("first_event"))


_APPLY_SQL = f"WITH {_LOG_SQL} SELECT \"index\", document_id, event_type, seq FROM ops QUALIFY row_number() OVER (PARTITION BY \"index\", document_id ORDER BY seq DESC) = 1 AND op = 'upsert'"


def _final(state: DataFrame) -> DataFrame:
    return apply.live(state).select("index", "document_id", F.col("document.event_type").alias("event_type"), "seq")


@query(_APPLY_SQL)
def apply_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(apply.last_operations(_ops(spark, sf_dir)))


@query(_APPLY_SQL)
def apply_with_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = _ops(spark, sf_dir)
    replayed = ops.join(F.broadcast(ops.agg((F.max("seq") / 2).alias("half"))), F.col("seq") >= F.col("half")).drop("half")
    return _final(apply.merged(apply.last_operations(ops), replayed))


def binlog(events: DataFrame) -> DataFrame:
    """The events as entries of a transaction log."""
    kind, n = F.col("event_type"), F.col("event_id")
    name = F.when(kind == "signup", "query").when(kind == "purchase", "xid").when(kind == "view", "rows").when(n % 11 == 0, "rotate").when((kind == "error") & (n % 7 == 0), "transaction_payload").when(kind == "error", "heartbeat").otherwise("query")
    text = F.when(kind == "signup", "BEGIN").when(n % 5 == 0, " commit; ").when(n % 5 == 1, "SAVEPOINT s").otherwise("CREATE TABLE t (a INT)")
    return events.select(
        n.alias("seq"), name.alias("kind"), F.when(name == "query", text).alias("query"), F.when(n % 13 == 0, 0).otherwise(n * 10 + 10).cast("long").alias("log_pos"),
        F.when(name == "rotate", F.format_string("bin.%06d", n)).alias("rotate_file"), F.when(name == "rotate", F.lit(4)).cast("long").alias("rotate_pos"),
    )


_SAFE_SQL = """
WITH k AS (SELECT event_id AS seq, CASE WHEN event_type = 'signup' THEN 'query' WHEN event_type = 'purchase' THEN 'xid' WHEN event_type = 'view' THEN 'rows' WHEN event_id % 11 = 0 THEN 'rotate' WHEN event_type = 'error' AND event_id % 7 = 0 THEN 'payload' WHEN event_type = 'error' THEN 'heartbeat' ELSE 'query' END AS kind,
  CASE WHEN event_type = 'signup' THEN 'BEGIN' WHEN event_id % 5 = 0 THEN 'COMMIT' ELSE 'OTHER' END AS text, CASE WHEN event_id % 13 = 0 THEN 0 ELSE event_id * 10 + 10 END AS log_pos FROM events),
f AS (SELECT *, kind = 'xid' OR kind = 'query' AND text = 'COMMIT' AS ends, kind IN ('rows', 'payload') OR kind = 'query' AND text = 'BEGIN' AS opens FROM k),
b AS (SELECT *, coalesce(last_value(CASE WHEN opens THEN true WHEN ends THEN false END IGNORE NULLS) OVER w, false) AS was_open, coalesce(last_value(CASE WHEN kind = 'payload' THEN true WHEN ends THEN false END IGNORE NULLS) OVER w, false) AS was_packed FROM f WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'rotate' THEN 4 WHEN log_pos <> 0 AND NOT was_packed THEN log_pos END IGNORE NULLS) OVER w, 4) AS current_pos, coalesce(last_value(CASE WHEN kind = 'rotate' THEN printf('bin.%06d', seq) END IGNORE NULLS) OVER w, 'bin.000001') AS current_file, ends OR (kind = 'rotate' OR kind = 'query' AND text = 'OTHER') AND NOT was_open AS safe FROM b WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING))
SELECT seq, current_file, CAST(current_pos AS BIGINT) AS current_pos, coalesce(last_value(CASE WHEN safe THEN current_file END IGNORE NULLS) OVER w, 'bin.000001') AS safe_file, CAST(coalesce(last_value(CASE WHEN safe THEN current_pos END IGNORE NULLS) OVER w, 4) AS BIGINT) AS safe_pos FROM p WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING)"""


@query(_SAFE_SQL)
def safe_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = binlog(table(spark, sf_dir, "events").select("event_id", "event_type"))
    return positions.safe_positions(log, "bin.000001", 4).select("seq", "current_file", "current_pos", "safe_file", "safe_pos")


@query(f"SELECT arg_max(safe_file, seq) AS file, arg_max(safe_pos, seq) AS pos FROM ({_SAFE_SQL})")
def saved_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position that a stream over the log has saved when it ends: not the last one, if a transaction is open there."""
    folder = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    log = binlog(table(spark, sf_dir, "events").select("event_id", "event_type")).withColumnRenamed("log_pos", "pos")
    log.withColumn("file", F.lit(None).cast("string")).repartitionByRange(3, "seq").sortWithinPartitions("seq").write.parquet(f"{folder}/log")
    stored = spark.read.parquet(f"{folder}/log")
    saved: list[Position] = []
    commit = pipeline.SafeCheckpoint(Files(spark, f"{folder}/state"), Position("bin.000001", 4), saved.append, every_events=1)
    for k, name in enumerate(sorted(x.rsplit("/", 1)[1] for x in stored.inputFiles())):  # files in the order of the log
        events = spark.readStream.schema(stored.schema).option("pathGlobFilter", name).parquet(f"{folder}/log")
        events.writeStream.foreachBatch(lambda batch, _: commit(batch)).option("checkpointLocation", f"{folder}/checkpoint-{k}").trigger(availableNow=True).start().awaitTermination()
    commit.finish()
    return spark.createDataFrame([(saved[-1].file, saved[-1].pos)], "file string, pos long")


@query(f"""
WITH {_LOG_SQL} SELECT count(*) AS operations, count(*) FILTER (WHERE op = 'upsert') AS upserts, count(*) FILTER (WHERE op = 'delete') AS deletes, count(event_type) AS documents_with_body,
CAST(coalesce(sum(strlen('{{"user_id":' || document_id || ',"event_type":"' || event_type || '"}}')), 0) AS BIGINT) AS bytes_sent, CASE WHEN count(*) = 0 THEN 0.0 ELSE count(*) FILTER (WHERE op = 'delete') / count(*) END AS delete_share FROM ops""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.volumes(_ops(spark, sf_dir)).withColumn("delete_share", metrics.ratio(F.col("deletes"), F.col("operations")))


@query("SELECT 'bin.000001' AS file, max(event_id) * 100 + 4 AS pos FROM events")
def current_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.current_position(_log(spark, sf_dir))


@query("SELECT o_orderkey, \"o_orderstatus\" AS status FROM orders WHERE o_orderstatus = 'F'")
def resolved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by their zero-based place, as a log without names has them, and quoted."""
    orders = table(spark, sf_dir, "orders")
    key, status = (quoted(column_of(raw, orders.columns)) for raw in ("@0", "@2"))
    return orders.where(f"{status} = 'F'").selectExpr(key, f"{status} AS status")


@query("""
SELECT o_custkey AS seq, CAST(n AS INTEGER) AS row_no, k AS key FROM (
  SELECT o_custkey, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders)""")
def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with several rows, taken apart again in their order."""
    pair = F.struct("o_orderkey", F.lit("after").alias("side"))
    events = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("seq")).agg(F.array_sort(F.collect_list(pair)).alias("rows"))
    return changes.expanded(events).select("seq", "row_no", F.col("o_orderkey").alias("key"))


@query(_APPLY_SQL)
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as files, streamed into an index; its documents as they are then."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    plan = _users(spark, sf_dir)
    _log(spark, sf_dir).drop("before_present", "after_present", "before_unknown", "after_unknown").repartitionByRange(4, "seq").write.parquet(f"{folder}/changes")
    stored = spark.read.parquet(f"{folder}/changes")
    names = [F.lit(None).cast("array<string>").alias(f"{s}_{n}") for s in ("before", "after") for n in ("present", "unknown")]
    events = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/changes").select("*", *names)
    store = IndexStore(spark, f"{folder}/indexes")
    store.prepare([plan])
    pipeline.start(events, store, [plan], f"{folder}/checkpoint").awaitTermination()
    state = store.state("users")
    if state is None:
        raise RuntimeError("the stream left no index")
    return _final(state)
