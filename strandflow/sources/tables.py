"""Source tables by path or JDBC, and change events by batch or stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandflow.sources.files import Files


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A database table; with a numeric key and its bounds it is read in ``partitions`` ranges at once.

    Filters and column lists are pushed to the database. The driver's jar has to be on the class path.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    return reader.load()


#: What every entry of a log has; transaction marks have no more, and no table.
_LONGS, _INTS = ("seq", "pos", "rotate_pos"), ("row_no",)
MARKS = T.StructType([
    T.StructField(n, T.LongType() if n in _LONGS else T.IntegerType() if n in _INTS else T.StringType())
    for n in ("seq", "file", "pos", "kind", "database", "table", "row_no", "query", "rotate_file", "rotate_pos")
])
#: The folder of a log's transaction marks, beside those of its tables.
TRANSACTIONS = "transactions"


def image_type(row: T.StructType) -> T.StructType:
    """The type of a change event of a table with rows of type ``row``."""
    names = T.ArrayType(T.StringType())
    pair = [T.StructField("before", row), T.StructField("after", row)]
    sets = [T.StructField(f"{s}_{n}", names) for s in ("before", "after") for n in ("present", "unknown")]
    return T.StructType(MARKS.fields[:7] + pair + sets + MARKS.fields[7:])


def change_events(spark: SparkSession, path: str, row: T.StructType, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Change events from Parquet files, as they are or as a stream of files; ``row`` is the table's row type."""
    if not stream:
        return spark.read.schema(image_type(row)).parquet(path)
    reader = spark.readStream.schema(image_type(row))
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def routed_or_fail(events: DataFrame) -> DataFrame:
    """Row events must name their table; one that doesn't stops the run rather than being skipped."""
    lost = (F.col("kind") == "rows") & F.col("table").isNull()
    guard = F.when(lost, F.raise_error(F.concat_ws(":", F.lit("no table map for the rows at"), "file", "pos")).cast("string")).otherwise(F.col("table"))
    return events.withColumn("table", guard)


def place(files: Files, database: str | None, table: str, tables: list[tuple[str | None, str]], end: str = "") -> str:
    """The path of a table: under its database, or right below the root if no other database has a table of that name."""
    own = f"{database}/{table}{end}"
    if database and files.exists(own):
        return files.path(own)
    if len({d for d, t in tables if t == table}) > 1:
        raise ValueError(f"several databases have a table {table!r}: {own} is missing")
    return files.path(table + end)


def change_log(spark: SparkSession, folder: str, rows: dict[tuple[str | None, str], T.StructType], stream: bool = False) -> tuple[DataFrame, dict[tuple[str | None, str], str]]:
    """The changes of several tables and the transaction marks as one log, and the column that has each table's images.

    One log, so that one position holds for all of it and a batch is applied as a whole.
    """
    files, parts, columns = Files(spark, folder), [], {}
    for n, ((database, table), row) in enumerate(rows.items()):
        columns[database, table] = f"images_{n}"
        events = routed_or_fail(change_events(spark, place(files, database, table, list(rows)), row, stream))
        images = F.struct(*[c for c in events.columns if c not in MARKS.names]).alias(f"images_{n}")
        parts.append(events.select(*MARKS.names, images))
    if files.exists(TRANSACTIONS):
        reader = spark.readStream if stream else spark.read
        parts.append(reader.schema(MARKS).parquet(files.path(TRANSACTIONS)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), columns


def file_number(file: Column) -> Column:
    """The number that a log file's name ends with: it orders positions, not the name's text."""
    return F.coalesce(F.regexp_extract(file, r"(\d+)$", 1).try_cast("long"), F.lit(-1))


def from_position(log: DataFrame, file: str, pos: int) -> DataFrame:
    return log.where(F.struct(file_number(F.col("file")), F.col("pos")) >= F.struct(file_number(F.lit(file)), F.lit(pos).cast("long")))


def last_position(log: DataFrame) -> DataFrame:
    """(file, pos) of the entry that is furthest by file number and position, one row."""
    return log.agg(F.max_by(F.struct("file", "pos"), F.struct(file_number(F.col("file")), F.col("pos"))).alias("p")).select("p.file", "p.pos")


def current_position(log: DataFrame) -> DataFrame:
    """(file, pos) of the last event by order, one row."""
    return log.agg(F.max_by(F.struct("file", "pos"), "seq").alias("p")).select("p.file", "p.pos")
