"""A table specification bound to the DataFrame that holds its rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandflow.functions.values import document_id, document_value
from strandflow.spec import SpecError, TableSpec


@dataclass(frozen=True)
class TablePlan:
    spec: TableSpec
    source: DataFrame

    @property
    def schema(self) -> T.StructType:
        return self.source.schema

    def kind(self, name: str) -> T.DataType:
        return self.schema[name].dataType

    def value(self, name: str, of: Column | None = None) -> Column:
        """A field as the document holds it, from the row or from a struct that has it."""
        return document_value(F.col(quoted(name)) if of is None else of[name], self.kind(name))

    def key_text(self, of: Column | None = None) -> Column:
        name = self.spec.primary_key
        return document_id(F.col(quoted(name)) if of is None else of[name], self.kind(name))

    def document(self, of: Column | None = None) -> Column:
        return F.struct(*[self.value(f, of).alias(self.spec.target(f)) for f in self.spec.fields])

    @property
    def rows(self) -> DataFrame:
        """The source rows that belong in the index."""
        return self.source.where(F.expr(self.spec.where_clause)) if self.spec.where_clause else self.source


def bind(spec: TableSpec, source: DataFrame) -> TablePlan:
    """The plan, once every field, watched field and the key are known to be columns of ``source``."""
    if not source.columns:
        raise SpecError(f"table {spec.table!r} has no columns")
    if found := spec.problems() + [f"table {spec.table!r} has no column {c!r}" for c in spec.missing_columns(source.columns)]:
        raise SpecError("; ".join(found))
    return TablePlan(spec, source)


def bind_all(specs: tuple[TableSpec, ...], sources: Mapping[tuple[str | None, str], DataFrame]) -> list[TablePlan]:
    if missing := [f"{s.database}.{s.table}" for s in specs if (s.database, s.table) not in sources]:
        raise SpecError(f"no source for {', '.join(missing)}")
    return [bind(s, sources[s.database, s.table]) for s in specs]


def quoted(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def column_of(raw: str, columns: list[str]) -> str:
    """A column by name, or by @N, its place counted from zero."""
    if not raw.startswith("@"):
        return raw
    if not raw[1:].isdigit() or int(raw[1:]) >= len(columns):
        raise SpecError(f"column {raw} is not among {len(columns)} columns")
    return columns[int(raw[1:])]


def route(events: DataFrame, plans: list[TablePlan]) -> DataFrame:
    """Each event once for every plan of its database and table, with the plan's ``index``; others drop out.

    The plans come from the specification, which the driver holds anyway, so they are broadcast.
    """
    rows = [(p.spec.database, p.spec.table, p.spec.index) for p in plans]
    known = events.sparkSession.createDataFrame(rows, "to_database string, to_table string, index string")
    on = events["database"].eqNullSafe(F.col("to_database")) & (events["table"] == F.col("to_table"))
    return events.join(F.broadcast(known), on).drop("to_database", "to_table")
