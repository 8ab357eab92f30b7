"""Safe restart positions in a change log: only where no transaction is open.

Kinds: xid, query, table_map, rows, gtid, anonymous_gtid, transaction_payload, rotate, and others that say nothing.
Everything is a last known value over the log's order, so a log of any length is done in ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandflow.functions.values import statement
from strandflow.operators.ranges import last_known, ordered

@dataclass(frozen=True)
class LogState:
    """What the events so far leave behind: where the log is, the last safe place, and what is open there."""

    file: str
    pos: int
    safe_file: str
    safe_pos: int
    open: bool = False
    packed: bool = False

    @staticmethod
    def at(file: str, pos: int) -> LogState:
        return LogState(file, pos, file, pos)


OPENERS = ("table_map", "rows", "gtid", "anonymous_gtid", "transaction_payload")


def _roles() -> tuple[Column, Column, Column]:
    """Whether an event opens a transaction, ends one, or is another statement."""
    kind, text = F.col("kind"), statement(F.col("query"))
    query = kind == "query"
    ends = (kind == "xid") | (query & text.isin("COMMIT", "ROLLBACK"))
    opens = kind.isin(*OPENERS) | (query & (text == "BEGIN"))
    return F.coalesce(opens, F.lit(False)), F.coalesce(ends, F.lit(False)), F.coalesce(query & ~text.isin("BEGIN", "COMMIT", "ROLLBACK"), F.lit(False))


def _flagged(log: DataFrame) -> DataFrame:
    opens, ends, _ = _roles()
    return log.withColumn("_open", F.when(opens, True).when(ends, False)).withColumn("_packed", F.when(F.col("kind") == "transaction_payload", True).when(ends, False))


def safe_positions(log: DataFrame, start_file: str, start_pos: int, state: LogState | None = None, ranges: int | None = None) -> DataFrame:
    """``log`` (seq, kind, query, log_pos, rotate_file, rotate_pos) with current and safe (file, pos) after each event.

    ``state`` is what earlier events left, in place of a start with nothing open. Within a compressed transaction the header positions don't count; an event with position 0 has none. A statement
    outside a transaction, and a rotation outside one, are safe; a rotation always moves the current position.
    """
    state = state or LogState.at(start_file, start_pos)
    _, ends, other = _roles()
    rows = ordered(_flagged(log), "seq", ranges=ranges).settled().scan(_was_open=last_known("_open", False), _was_packed=last_known("_packed", False))
    was_open, was_packed = F.coalesce("_was_open", F.lit(state.open)), F.coalesce("_was_packed", F.lit(state.packed))
    rotate = F.col("kind") == "rotate"
    moved = F.when(rotate, F.col("rotate_pos")).when((F.col("log_pos") != 0) & ~was_packed, F.col("log_pos"))
    rows = rows.with_column("_pos", moved).with_column("_file", F.when(rotate, F.col("rotate_file")).otherwise(F.col("file") if "file" in log.columns else F.lit(None)))
    rows = rows.settled().scan(current_pos=last_known("_pos"), current_file=last_known("_file"))
    rows = rows.with_column("current_pos", F.coalesce("current_pos", F.lit(state.pos).cast("long"))).with_column("current_file", F.coalesce("current_file", F.lit(state.file)))
    safe = ends | ((other | rotate) & ~was_open)
    at = F.when(safe, F.struct(F.col("current_file").alias("file"), F.col("current_pos").alias("pos")))
    rows = rows.with_column("_at", at).settled().scan(_safe=last_known("_at")).done()
    rows = rows.withColumn("safe_file", F.coalesce("_safe.file", F.lit(state.safe_file))).withColumn("safe_pos", F.coalesce("_safe.pos", F.lit(state.safe_pos).cast("long")))
    return rows.drop("_open", "_packed", "_was_open", "_was_packed", "_pos", "_file", "_at", "_safe")


#: Events up to which a batch is looked through as one range.
SMALL = 100_000


def advanced(log: DataFrame, state: LogState) -> LogState:
    """The state after the events of ``log`` (as for ``safe_positions``, and file), which come after those of ``state``."""
    log = log.distinct()  # an event with several rows comes once
    n = log.count()
    if not n:
        return state
    rows = safe_positions(log, state.file, state.pos, state, 1 if n <= SMALL else None)
    at = F.struct("current_file", "current_pos", "safe_file", "safe_pos")
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq")))
    r = _flagged(rows).agg(F.max_by(at, "seq").alias("at"), latest("_open").alias("open"), latest("_packed").alias("packed")).first()
    known = lambda new, old: old if new is None else new
    return LogState(*r["at"], known(r["open"], state.open), known(r["packed"], state.packed))
