"""Delay and alert reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.times import DAY_SECS, epoch_day


def delay_by_stop(fused: DataFrame) -> DataFrame:
    return (
        fused.groupBy("stop_id")
        .agg(F.avg("departure_delay").alias("avg_departure_delay"))
        .orderBy(F.desc("avg_departure_delay"), "stop_id")
    )


def delay_by_stop_time(fused: DataFrame) -> DataFrame:
    """Average arrival delay by stop and by quarter, month, day and hour of the schedule."""
    at = F.col("sch_arrival_time")
    day = epoch_day(at)
    return (
        fused.filter("sch_arrival_time is not null")
        .groupBy(
            "stop_name",
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.day(day).alias("day"),
            F.floor(F.pmod(at, F.lit(DAY_SECS)) / 3600).cast("int").alias("hour"),
        )
        .agg(F.avg("arrival_delay").alias("avg_arrival_delay"))
    )


def delay_arrival_departure(fused: DataFrame) -> DataFrame:
    return (
        fused.groupBy("stop_name")
        .agg(
            F.avg("arrival_delay").alias("avg_arrival_delay"),
            F.avg("departure_delay").alias("avg_departure_delay"),
        )
        .orderBy(F.desc("avg_arrival_delay"), "stop_name")
    )


def alerts_by_route(alerts: DataFrame, routes: DataFrame, rt_trips: DataFrame) -> DataFrame:
    """Alerts per named route that has realtime trips, most severe minimum first.

    Alerts are counted at their own grain before the joins, and trips only decide whether
    a route is listed, so no row is counted twice.
    """
    counts = alerts.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("alerts"), F.min("severity_level").alias("min_severity")
    )
    named = (
        routes.filter("route_long_name is not null")
        .groupBy(F.col("route_id").cast("string").alias("route_id"), "route_long_name")
        .agg(F.max("route_short_name").alias("route_short_name"))
    )
    seen = rt_trips.filter("trip_id is not null").select("route_id").distinct()
    return (
        counts.join(named, "route_id")
        .join(seen, "route_id", "left_semi")
        .select("route_id", "route_long_name", "route_short_name", "alerts", "min_severity")
        .orderBy(F.desc("min_severity"), "route_id", "route_long_name")
    )


def delay_by_route_direction(rt_stops: DataFrame, rt_trips: DataFrame) -> DataFrame:
    """Average departure delay of realtime stop rows by route and direction of their trip."""
    per_trip = rt_stops.groupBy("trip_id").agg(
        F.sum("departure_delay").alias("_sum"), F.count("departure_delay").alias("_n")
    )
    direction = rt_trips.select("trip_id", "route_id", "direction_id").distinct()
    return (
        per_trip.join(direction, "trip_id")
        .groupBy("route_id", "direction_id")
        .agg((F.sum("_sum") / F.sum("_n")).alias("avg_departure_delay"))
    )
