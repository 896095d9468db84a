"""Readers and writers of schedule data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.functions.times import clock_secs
from headway.schemas import GTFS_FILES


ROWS_PER_FILE = 5_000_000


def read_gtfs(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One GTFS text file with its fixed column types."""
    return (
        spark.read.schema(GTFS_FILES[table])
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .csv(f"{folder}/{table}.txt")
    )


def write_gtfs(df: DataFrame, folder: str, table: str) -> None:
    """Write a table as GTFS text that ``read_gtfs`` reads: its columns in file order, absent ones empty."""
    fields = StructType.fromDDL(GTFS_FILES[table])
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(f"{folder}/{table}.txt")


def stop_calls(stop_times: DataFrame) -> DataFrame:
    """Stop times with whole seconds of the service day instead of clock text."""
    return stop_times.select(
        "trip_id",
        "stop_id",
        "stop_sequence",
        clock_secs(F.col("arrival_time")).alias("arr_secs"),
        clock_secs(F.col("departure_time")).alias("dep_secs"),
    )


def read_day(spark: SparkSession, folder: str, day: str) -> DataFrame:
    """One weekday of a stored timetable table; other days' folders are not listed."""
    return spark.read.parquet(folder).filter(F.col("day") == day)


def deal_days(df: DataFrame, spread_by: str, services: DataFrame | None = None) -> DataFrame:
    """Rows by day, in balanced partitions sorted by day and ``spread_by``.

    With ``services (day, service_id)`` the rows of ``df`` have a service instead of a day and are sent
    to their task once for all its days.
    """
    if services is None:
        dealt = df.hint("rebalance", "day", spread_by)
    else:
        dealt = df.hint("rebalance", spread_by).join(services, "service_id").drop("service_id")
    return dealt.sortWithinPartitions("day", spread_by)


def write_days(df: DataFrame, folder: str, spread_by: str, rows_per_file: int = ROWS_PER_FILE, services: DataFrame | None = None) -> None:
    """Overwrite the days present in ``df`` (or of its ``services``, see ``deal_days``), each day in sorted files.

    The size of the data decides the number of tasks: Spark merges small partitions and
    splits large ones, also those of a single ``spread_by`` value.
    """
    (
        deal_days(df, spread_by, services)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("day")
        .parquet(folder)
    )


def write_csv(df: DataFrame, folder: str) -> None:
    """CSV with a header per part file; arrays become JSON text."""
    flat = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct") else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(folder)


def read_database(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A database table; all connection details come from the caller.

    Filters, columns and ``orderBy().limit()`` put on the result are pushed down. Give
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` for a
    parallel scan of a large table.
    """
    return spark.read.format("jdbc").options(**options).load()
