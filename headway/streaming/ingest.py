"""Realtime feeds as streams into keyed tables.

A snapshot arrives as a file in a landing folder, in either spelling of feed JSON. Every micro-batch
is parsed once and merged into the tables it fills, each a ``KeyedTable``: a replayed batch changes
nothing, a restarted stream goes on where it was, and a later batch corrects an earlier one of the
same snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from headway.operators.merge import SNAPSHOT, first_by_key
from headway.schemas import REALTIME_TABLES
from headway.sources import feeds
from headway.sources.keyed import BUCKETS, KeyedTable
from headway.sources.workspace import delete_path

# Tables that one feed fills, and what makes their rows of a message.
TRIP_TABLES: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "trips": feeds.feed_trips,
    "stops": feeds.feed_stops,
    "vehicles": feeds.feed_vehicles,
}
ALERT_TABLES: Mapping[str, Callable[[DataFrame], DataFrame]] = {"alerts": feeds.feed_alerts}


def read_text_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """The files of a landing folder as whole texts, in the column ``value``."""
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def read_feed_stream(
    spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100
) -> DataFrame:
    """Messages of one spelling, given by its schema."""
    return (
        spark.readStream.schema(schema)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def realtime_table(spark: SparkSession, table: str, folder: str, buckets: int = BUCKETS) -> KeyedTable:
    schema, keys = REALTIME_TABLES[table]
    return KeyedTable(spark, folder, schema, keys, buckets)


def upsert_stream(rows: DataFrame, table: str, folder: str, checkpoint: str, buckets: int = BUCKETS) -> DataStreamWriter:
    """Merge a stream of flat rows into ``folder``; start it with the trigger wanted."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        realtime_table(batch.sparkSession, table, folder, buckets).merge(batch, batch_id, checkpoint)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def upsert_feed(
    texts: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    tables: Mapping[str, Callable[[DataFrame], DataFrame]],
    folder: str,
    checkpoint: str,
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Fill several tables, ``<folder>/<table>``, from one stream of feed texts.

    The parsed messages of a batch are stored before the tables are filled from them, so a file is
    read and parsed once however many tables it fills, also when an executor is lost on the way.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = f"{folder}/_messages/{batch_id}"
        parse(batch).write.mode("overwrite").parquet(stored)
        messages = spark.read.parquet(stored)
        for table, flatten in tables.items():
            realtime_table(spark, table, f"{folder}/{table}", buckets).merge(flatten(messages), batch_id, checkpoint)
        delete_path(spark, stored)

    return texts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def upsert_trip_feed(spark: SparkSession, landing: str, folder: str, checkpoint: str, files_per_batch: int = 100, buckets: int = BUCKETS) -> DataStreamWriter:
    """Trips, stops and vehicles from one pass over the trip update feed."""
    texts = read_text_stream(spark, landing, files_per_batch)
    return upsert_feed(texts, feeds.trip_messages, TRIP_TABLES, folder, checkpoint, buckets)


def upsert_alert_feed(spark: SparkSession, landing: str, folder: str, checkpoint: str, files_per_batch: int = 100, buckets: int = BUCKETS) -> DataStreamWriter:
    texts = read_text_stream(spark, landing, files_per_batch)
    return upsert_feed(texts, feeds.alert_messages, ALERT_TABLES, folder, checkpoint, buckets)


def current_table(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """The latest row per key; of equal snapshots the one that arrived in the later batch."""
    return realtime_table(spark, table, folder).read()


def suppress_duplicates(rows: DataFrame, table: str, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated keys that arrive within ``delay``; state older than that is let go.

    A batch DataFrame has no order of arrival: the least row of a key by its other columns stays.
    """
    keys = list(REALTIME_TABLES[table][1])
    if not rows.isStreaming:
        return first_by_key(rows, keys)
    timed = rows.withColumn("_seen", F.timestamp_seconds(SNAPSHOT)).withWatermark("_seen", delay)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_seen")
