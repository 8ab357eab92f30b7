"""Ordered computations over a whole table, in parallel: row numbers, previous rows, running sums, last known values.

Rows are dealt to ranges of the order's first column; a window works within a range, and what it needs of the rows before
is carried over from a table with one row for each range. So no task sorts the whole table, as a window without a
partition would have it. A scan reads its rows twice, for the ranges' totals and for the rows; ``settled`` writes them
to the shared checkpoint folder first, so that scans on scans stay linear.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandflow.session import checkpointed

#: Rows that a range holds about, ranges at most, and for each of them the values of the first column that the edges are
#: taken from: those with the least hashes.
ROWS, RANGES, SAMPLE = 250_000, 2048, 64
RANGE = "_range"


@dataclass(frozen=True)
class Scan:
    """A value within a range, a range's total, how totals of the ranges before are put together, and with the value."""

    here: Callable[[Ordered], Column]
    total: Callable[[Ordered], Column]
    before: Callable[[str], Column]
    joined: Callable[[Column, Column], Column]


def number() -> Scan:
    """Rows numbered from 1."""
    return Scan(lambda o: F.row_number().over(o.within), lambda o: F.count("*"), F.sum, lambda here, before: here + F.coalesce(before, F.lit(0)))


def running_sum(value: str) -> Scan:
    return Scan(
        lambda o: F.sum(value).over(o.within.rowsBetween(Window.unboundedPreceding, 0)), lambda o: F.sum(value), F.sum,
        lambda here, before: F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0)),
    )


def previous(value: str) -> Scan:
    """The row before's ``value``; null in the first row."""
    boxed = F.struct(F.col(value).alias("v"))
    return Scan(
        lambda o: F.lag(boxed).over(o.within), lambda o: F.max_by(boxed, F.struct(*o.order)),
        lambda c: F.last(c, ignorenulls=True), lambda here, before: F.coalesce(here, before)["v"],
    )


def last_known(value: str, inclusive: bool = True) -> Scan:
    """The latest ``value`` that is not null, up to and with this row or only before it."""
    until = 0 if inclusive else -1
    return Scan(
        lambda o: F.last(value, ignorenulls=True).over(o.within.rowsBetween(Window.unboundedPreceding, until)),
        lambda o: F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*o.order))), lambda c: F.last(c, ignorenulls=True), F.coalesce,
    )


@dataclass(frozen=True)
class Ordered:
    """Rows with their range; ``by`` are columns that keep sequences apart, ``order`` makes a total order in each."""

    rows: DataFrame
    order: tuple[str, ...]
    by: tuple[str, ...] = ()

    @property
    def within(self):
        return Window.partitionBy(*self.by, RANGE).orderBy(*self.order)

    def scan(self, **outs: Scan) -> Ordered:
        """The rows with a column for each scan, all in one go."""
        keys = (*self.by, RANGE)
        totals = self.rows.groupBy(*keys).agg(*[s.total(self).alias(f"_t_{out}") for out, s in outs.items()])
        earlier = Window.partitionBy(*self.by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[s.before(f"_t_{out}").over(earlier).alias(f"_b_{out}") for out, s in outs.items()])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        rows = self.rows.withColumns({f"_h_{out}": s.here(self) for out, s in outs.items()}).join(carried, same, "left")
        rows = rows.withColumns({out: s.joined(F.col(f"_h_{out}"), F.col(f"_b_{out}")) for out, s in outs.items()})
        return Ordered(rows.drop(*[f"_k_{k}" for k in keys], *[f"_{x}_{out}" for out in outs for x in "hb"]), self.order, self.by)

    def settled(self) -> Ordered:
        return Ordered(checkpointed(self.rows), self.order, self.by)

    def with_column(self, name: str, value: Column) -> Ordered:
        return Ordered(self.rows.withColumn(name, value), self.order, self.by)

    def done(self) -> DataFrame:
        return self.rows.drop(RANGE)


def ordered(rows: DataFrame, *order: str, by: tuple[str, ...] = (), ranges: int | None = None) -> Ordered:
    """``rows`` dealt to as many ranges of ``order[0]`` as their number asks for, by edges from a sample of bounded size."""
    first = order[0]
    if ranges is None:
        ranges = min(RANGES, max(1, -(-rows.count() // ROWS)))
    if ranges == 1:
        return Ordered(rows.withColumn(RANGE, F.lit(0)), tuple(order), by)
    sample = rows.select(first).where(F.col(first).isNotNull()).orderBy(F.xxhash64(first)).limit(SAMPLE * ranges)
    values = sorted({r[0] for r in sample.collect()})
    step = max(1, -(-len(values) // ranges))
    place = F.coalesce(_place(F.col(first), values[step::step], 0), F.lit(0))
    return Ordered(rows.withColumn(RANGE, place), tuple(order), by)


def _place(col: Column, edges: list, before: int) -> Column:
    """``before`` plus the number of ``edges`` that are no larger, by halving."""
    if not edges:
        return F.lit(before)
    half = len(edges) // 2
    return F.when(col >= F.lit(edges[half]), _place(col, edges[half + 1 :], before + half + 1)).otherwise(_place(col, edges[:half], before))
