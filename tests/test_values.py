import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandflow.functions import values


def value(spark, sql, kind=None):
    df = spark.sql(f"SELECT {sql} AS v")
    kind = kind or df.schema["v"].dataType
    return df.select(values.document_value(F.col("v"), kind).alias("d"), values.document_id(F.col("v"), kind).alias("i")).first()


def test_values_and_ids(spark):
    assert tuple(value(spark, "CAST(NULL AS BIGINT)")) == (None, "")
    assert tuple(value(spark, "-12L")) == (-12, "-12")
    assert tuple(value(spark, "'SKU-42'")) == ("SKU-42", "SKU-42")
    assert value(spark, "CAST(18446744073709551615 AS DECIMAL(20,0))").i == "18446744073709551615"
    assert value(spark, "CAST(1.50 AS DECIMAL(5,2))").d == "1.50"
    assert value(spark, "X'61FF62'").d == "a�b"
    assert value(spark, "CAST(0.1 AS FLOAT)").d == 0.10000000149011612
    assert value(spark, "DOUBLE('NaN')").d is None and value(spark, "DOUBLE('-Infinity')").d is None
    assert value(spark, "1.0D").i == "1" and value(spark, "1e16D").i == "10000000000000000" and value(spark, "1.5D").i == "1.5"
    assert value(spark, "array(1, 2)").d == "[1,2]"


def test_times(spark):
    assert value(spark, "TIMESTAMP_NTZ'2026-06-28 17:08:09.000042'").d == "2026-06-28T17:08:09.000042"
    assert value(spark, "TIMESTAMP_NTZ'2026-06-28 17:08:09'").i == "2026-06-28T17:08:09"
    assert value(spark, "DATE'2026-06-28'").d == "2026-06-28T00:00:00"
    df = spark.createDataFrame([(-dt.timedelta(days=2, hours=3, minutes=4, seconds=5, microseconds=6),), (dt.timedelta(hours=30),), (None,)], T.StructType([T.StructField("v", T.DayTimeIntervalType())]))
    assert [r.d for r in df.select(values.document_value(F.col("v"), T.DayTimeIntervalType()).alias("d")).collect()] == ["-51:04:05.000006", "30:00:00", None]


def test_json_keeps_nulls_and_statements_are_normalised(spark):
    r = spark.range(1).select(values.json_text(F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))).alias("j"), values.statement(F.lit(" rollback ; ")).alias("s")).first()
    assert tuple(r) == ('{"a":1,"b":null}', "ROLLBACK")
