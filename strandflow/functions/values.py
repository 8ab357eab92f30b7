"""Source values as document values and as document ids; snapshots and changes share them."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def format_datetime(ts: Column) -> Column:
    """ISO text to the second, with six digits of fraction only where there is one."""
    micros = F.expr("1000000") * F.date_part(F.lit("SECOND"), ts)
    fraction = F.pmod(F.round(micros).cast("bigint"), F.lit(1_000_000))
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fraction == 0, whole).otherwise(F.concat(whole, F.date_format(ts, ".SSSSSS")))


def format_time(interval: Column) -> Column:
    """[-]HH:MM:SS[.ffffff] of a day-time interval; hours run past 24."""
    part = lambda name: F.abs(F.date_part(F.lit(name), interval))
    second = part("SECOND")
    clock = F.format_string("%02d:%02d:%02d", part("DAY") * 24 + part("HOUR"), part("MINUTE"), F.floor(second).cast("int"))
    micros = F.round((second - F.floor(second)) * 1_000_000).cast("int")
    text = F.when(micros == 0, clock).otherwise(F.concat(clock, F.format_string(".%06d", micros)))
    signed = F.when(interval < F.expr("interval '0' second"), F.concat(F.lit("-"), text)).otherwise(text)
    return F.when(interval.isNotNull(), signed)


def document_value(col: Column, kind: T.DataType) -> Column:
    """The value as the document holds it: text, number, boolean or null.

    Bytes become text with U+FFFD for what is no UTF-8, floats doubles with null for NaN and infinities, decimals text
    (but for unsigned integers, decimal(20,0)), times ISO text, nested values JSON text.
    """
    if isinstance(kind, T.BinaryType):
        return F.make_valid_utf8(col.cast("string"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        wide = col.cast("double")
        return F.when(~F.isnan(wide) & (F.abs(wide) != float("inf")), wide)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return format_datetime(col.cast("timestamp_ntz") if isinstance(kind, T.DateType) else col)
    if isinstance(kind, T.DayTimeIntervalType):
        return format_time(col)
    if isinstance(kind, T.DecimalType) and (kind.precision, kind.scale) != (20, 0):
        return col.cast("string")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col


def document_id(col: Column, kind: T.DataType) -> Column:
    """The value as text; null is the empty text, and a whole floating number has no point."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        wide = col.cast("double")
        whole = (wide == F.floor(wide)) & (F.abs(wide) < 1e18)
        text = F.when(whole, F.expr("1") * wide.cast("decimal(38,0)")).cast("decimal(38,0)").cast("string")
        return F.coalesce(text, col.cast("string"), F.lit(""))
    return F.coalesce(document_value(col, kind).cast("string"), F.lit(""))


def json_text(document: Column) -> Column:
    """A document as JSON with its nulls."""
    return F.to_json(document, {"ignoreNullFields": "false"})


def json_bytes(document: Column) -> Column:
    return F.octet_length(json_text(document))


def logged_id(document: dict, key: str) -> str:
    """How a log names a document: its key as JSON, so that a text keeps its quotes, or a word for none."""
    return json.dumps(document[key], ensure_ascii=False, default=str) if key in document else "<missing>"


def statement(query: Column) -> Column:
    """Statement text for comparison: without surrounding space and final semicolons, in upper case."""
    return F.upper(F.regexp_replace(query, r"^\s+|[\s;]+$", ""))
