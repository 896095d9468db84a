"""Realtime feed messages as flat rows, for batch and streaming input alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import (
    ALERT_CAUSES,
    ALERT_EFFECTS,
    ALERT_FEED,
    ALERT_FEED_CAMEL,
    ALERT_SEVERITIES,
    MISSING,
    TRIP_FEED,
    TRIP_FEED_CAMEL,
)


def read_feed(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A folder of feed messages, one JSON document per file."""
    return spark.read.schema(schema).option("multiLine", True).json(folder)


def parse_feed(messages: DataFrame, column: str, schema: str) -> DataFrame:
    """Feed messages held as JSON text in ``column``."""
    return messages.select(F.from_json(column, schema).alias("m")).select("m.*")


def _enum(name: Column, values: tuple[str, ...]) -> Column:
    number = F.array_position(F.array(*[F.lit(v) for v in values]), name)
    return F.when(number > 0, number).cast("int")


def plain_trip_feed(messages: DataFrame, *kept: str) -> DataFrame:
    """Trip updates in the protobuf JSON spelling, recast to ``TRIP_FEED``."""

    def event(e: Column) -> Column:
        return F.when(
            e.isNotNull(),
            F.struct(e["delay"].alias("delay"), e["time"].try_cast("long").alias("time")),
        )

    def update(u: Column) -> Column:
        return F.struct(
            u["stopSequence"].alias("stop_sequence"),
            u["stopId"].alias("stop_id"),
            event(u["arrival"]).alias("arrival"),
            event(u["departure"]).alias("departure"),
        )

    def entity(e: Column) -> Column:
        t = e["tripUpdate"]
        trip = F.struct(
            t["trip"]["tripId"].alias("trip_id"),
            t["trip"]["startDate"].alias("start_date"),
            t["trip"]["routeId"].alias("route_id"),
            t["trip"]["directionId"].alias("direction_id"),
        )
        body = F.struct(
            t["timestamp"].try_cast("long").alias("timestamp"),
            F.when(t["trip"].isNotNull(), trip).alias("trip"),
            F.transform(t["stopTimeUpdate"], update).alias("stop_time_update"),
            t["vehicle"].alias("vehicle"),
        )
        return F.struct(e["id"].alias("id"), F.when(t.isNotNull(), body).alias("trip_update"))

    stamp = F.struct(F.col("header.timestamp").try_cast("long").alias("timestamp"))
    return messages.select(
        *kept, F.when(F.col("header").isNotNull(), stamp).alias("header"), F.transform("entity", entity).alias("entity")
    )


def plain_alert_feed(messages: DataFrame, *kept: str) -> DataFrame:
    """Alerts in the protobuf JSON spelling, recast to ``ALERT_FEED``."""

    def period(p: Column) -> Column:
        return F.struct(
            p["start"].try_cast("long").alias("start"), p["end"].try_cast("long").alias("end")
        )

    def informed(i: Column) -> Column:
        return F.struct(
            i["routeType"].alias("route_type"),
            i["routeId"].alias("route_id"),
            i["stopId"].alias("stop_id"),
        )

    def entity(e: Column) -> Column:
        a = e["alert"]
        body = F.struct(
            F.transform(a["activePeriod"], period).alias("active_period"),
            _enum(a["cause"], ALERT_CAUSES).alias("cause"),
            _enum(a["effect"], ALERT_EFFECTS).alias("effect"),
            _enum(a["severityLevel"], ALERT_SEVERITIES).alias("severity_level"),
            F.transform(a["informedEntity"], informed).alias("informed_entity"),
        )
        return F.struct(e["id"].alias("id"), F.when(a.isNotNull(), body).alias("alert"))

    stamp = F.struct(F.col("header.timestamp").try_cast("long").alias("timestamp"))
    return messages.select(
        *kept, F.when(F.col("header").isNotNull(), stamp).alias("header"), F.transform("entity", entity).alias("entity")
    )


# Names that only one of the two spellings has, as keys of the JSON text.
_CAMEL_KEYS = r'"(tripUpdate|stopTimeUpdate|tripId|activePeriod|informedEntity|severityLevel)"\s*:'


def parse_any_spelling(
    texts: DataFrame, column: str, schema: str, camel_schema: str, plain: Callable[..., DataFrame]
) -> DataFrame:
    """Feed messages held as JSON text, each in either spelling, as rows of ``schema``.

    A text is parsed once, by the schema of its own spelling.
    """
    camel = F.col(column).rlike(_CAMEL_KEYS)
    parsed = texts.select(
        F.when(camel, F.from_json(column, camel_schema)).alias("_camel"),
        F.when(~camel, F.from_json(column, schema)).alias("_plain"),
    )
    # The camel message under its own names for the recasting, the other one beside it.
    recast = plain(parsed.select("_plain", "_camel.*"), "_plain")
    return recast.select(*[F.coalesce(f"_plain.{c}", c).alias(c) for c in ("header", "entity")])


def read_trip_updates(spark: SparkSession, folder: str, camel: bool = False) -> DataFrame:
    if camel:
        return plain_trip_feed(read_feed(spark, folder, TRIP_FEED_CAMEL))
    return read_feed(spark, folder, TRIP_FEED)


def read_alerts(spark: SparkSession, folder: str, camel: bool = False) -> DataFrame:
    if camel:
        return plain_alert_feed(read_feed(spark, folder, ALERT_FEED_CAMEL))
    return read_feed(spark, folder, ALERT_FEED)


def trip_messages(texts: DataFrame, column: str = "value") -> DataFrame:
    """Trip update messages of texts in either spelling."""
    return parse_any_spelling(texts, column, TRIP_FEED, TRIP_FEED_CAMEL, plain_trip_feed)


def alert_messages(texts: DataFrame, column: str = "value") -> DataFrame:
    return parse_any_spelling(texts, column, ALERT_FEED, ALERT_FEED_CAMEL, plain_alert_feed)


def _or_missing(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(MISSING))


def _trip_entities(messages: DataFrame) -> DataFrame:
    return (
        messages.select(F.explode("entity").alias("e"))
        .filter("e.trip_update is not null")
        .select("e.trip_update.*")
        .withColumn("snapshot_ts", _or_missing("timestamp").cast("long"))
    )


def feed_trips(messages: DataFrame) -> DataFrame:
    return _trip_entities(messages).select("trip.*", "snapshot_ts")


def feed_stops(messages: DataFrame) -> DataFrame:
    """One row per stop time update; an update without any content is skipped."""
    updates = _trip_entities(messages).select(
        "trip.trip_id", "snapshot_ts", F.explode("stop_time_update").alias("u")
    )
    return updates.filter(
        "u.stop_id is not null or u.stop_sequence is not null "
        "or u.arrival is not null or u.departure is not null"
    ).select(
        "u.stop_id",
        "trip_id",
        "u.stop_sequence",
        _or_missing("u.arrival.delay").alias("arrival_delay"),
        _or_missing("u.arrival.time").cast("long").alias("arrival_time"),
        _or_missing("u.departure.delay").alias("departure_delay"),
        _or_missing("u.departure.time").cast("long").alias("departure_time"),
        "snapshot_ts",
    )


def feed_vehicles(messages: DataFrame) -> DataFrame:
    return (
        _trip_entities(messages)
        .filter("vehicle.id is not null")
        .select(
            F.col("vehicle.id").alias("vehicle_id"),
            "trip.trip_id",
            F.col("vehicle.label").alias("vehicle_label"),
            "snapshot_ts",
        )
    )


def feed_alerts(messages: DataFrame) -> DataFrame:
    """One row per informed entity that names a route; the first active period counts."""
    alerts = messages.select(
        _or_missing("header.timestamp").cast("long").alias("snapshot_ts"),
        F.explode("entity").alias("e"),
    ).filter("e.alert is not null")
    informed = alerts.select(
        "snapshot_ts",
        F.col("e.id").alias("alert_id"),
        F.get("e.alert.active_period", 0).alias("period"),
        "e.alert.cause",
        "e.alert.effect",
        "e.alert.severity_level",
        F.explode("e.alert.informed_entity").alias("i"),
    )
    return informed.filter("i.route_id is not null and i.route_id <> ''").select(
        "alert_id",
        "i.route_id",
        F.col("period.start").alias("active_period_start"),
        _or_missing("period.end").cast("long").alias("active_period_end"),
        F.coalesce("i.stop_id", F.lit(str(MISSING))).alias("stop_id"),
        "i.route_type",
        "snapshot_ts",
        "cause",
        "effect",
        "severity_level",
    )


def feed_counts(messages: DataFrame) -> DataFrame:
    """Entities, stop updates and vehicles of every snapshot."""
    entities = _trip_entities(messages)
    updates = F.filter(
        "stop_time_update",
        lambda u: u["stop_id"].isNotNull()
        | u["stop_sequence"].isNotNull()
        | u["arrival"].isNotNull()
        | u["departure"].isNotNull(),
    )
    return entities.groupBy("snapshot_ts").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.coalesce(F.size(updates), F.lit(0))).alias("stops"),
        F.count("vehicle.id").alias("vehicles"),
    )


def alert_counts(messages: DataFrame) -> DataFrame:
    """Alerts, informed entities and the kept ones among them, per snapshot."""
    alerts = messages.select(
        _or_missing("header.timestamp").cast("long").alias("snapshot_ts"), F.explode("entity").alias("e")
    ).filter("e.alert is not null")
    informed = F.col("e.alert.informed_entity")
    named = F.filter(informed, lambda i: i["route_id"] != "")
    return alerts.groupBy("snapshot_ts").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.sum(F.coalesce(F.size(informed), F.lit(0))).alias("informed"),
        F.sum(F.coalesce(F.size(named), F.lit(0))).alias("named"),
    )
