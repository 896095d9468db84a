"""Weekday timetables from the schedule files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.schedule import (
    same_day_calls,
    served_stops,
    services_by_date,
    services_by_day,
    trip_patterns,
    trips_in_service,
)
from headway.operators.transfers import walking_transfers
from headway.plans.network import forget_network, publish_network
from headway.sources.gtfs import ROWS_PER_FILE, read_gtfs, stop_calls, write_days
from headway.sources.workspace import Workspace, path_exists


@dataclass(frozen=True)
class Timetable:
    """Calls are stored once per service; ``services`` says on which days each one runs.

    ``calls``: trip_id, stop_id, stop_sequence, arr_secs, dep_secs, service_id, route_id, pattern;
    ``patterns`` has a row per trip.
    """

    services: DataFrame
    calls: DataFrame
    stops: DataFrame
    transfers: DataFrame
    patterns: DataFrame


def build_timetable(
    ws: Workspace, calendar: DataFrame, trips: DataFrame, calls: DataFrame, stops: DataFrame
) -> Timetable:
    services = ws.save(services_by_day(calendar), "services")
    running = trips_in_service(trips, services)
    kept = same_day_calls(calls)
    patterns = ws.save(trip_patterns(kept, running).select("trip_id", "route_id", "service_id", "pattern"), "patterns")
    dated = kept.join(patterns, "trip_id")
    stored = ws.save(dated, "calls")
    served = ws.save(
        served_stops(stops, stored).select("stop_id", "stop_name", "stop_lat", "stop_lon"), "stops"
    )
    transfers = ws.save(walking_transfers(ws, served), "transfers")
    return Timetable(services, stored, served, transfers, patterns)


_CALL = ("trip_id", "stop_id", "stop_sequence", "arr_secs", "dep_secs")


def calls_by_day(timetable: Timetable) -> DataFrame:
    return timetable.calls.join(timetable.services, "service_id").select("day", *_CALL, F.col("pattern").alias("route_id"))


def write_calls_by_day(timetable: Timetable, folder: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """``calls_by_day`` in sorted files per day; a call is sent to its task once, not once a day."""
    calls = timetable.calls.select("service_id", *_CALL, F.col("pattern").alias("route_id"))
    write_days(calls, folder, "trip_id", rows_per_file, timetable.services)


def stops_by_day(timetable: Timetable) -> DataFrame:
    """Stops served on each day."""
    served = (
        timetable.calls.select("service_id", "stop_id")
        .distinct()
        .join(timetable.services, "service_id")
        .select("day", "stop_id")
        .distinct()
    )
    return served.join(timetable.stops.select("stop_id", "stop_name"), "stop_id")


def transfers_by_day(timetable: Timetable) -> DataFrame:
    """Transfers whose two stops are both served on the day."""
    served = stops_by_day(timetable).select("day", "stop_id")
    return (
        timetable.transfers.join(served.withColumnRenamed("stop_id", "from_stop_id"), "from_stop_id")
        .join(served.withColumnRenamed("stop_id", "to_stop_id"), ["day", "to_stop_id"], "left_semi")
        .select("day", "from_stop_id", "to_stop_id", "transfer_time")
    )


def network_services(services: DataFrame, calendar: DataFrame, calendar_dates: DataFrame | None) -> DataFrame:
    """``(day, service_id)`` for weekdays and, where there are exceptions, for every date as ``yyyyMMdd``."""
    if calendar_dates is None:
        return services
    dated = services_by_date(calendar, calendar_dates)
    return services.unionByName(dated.select(F.date_format("service_date", "yyyyMMdd").alias("day"), "service_id"))


def preprocess(spark: SparkSession, source: str, target: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Schedule files in; per-day Parquet tables ``stop_times``, ``transfers``, ``stops`` and a new version
    of the ``network`` that journeys are searched on out."""
    ws = Workspace(spark)
    try:
        calendar, trips = read_gtfs(spark, source, "calendar"), read_gtfs(spark, source, "trips")
        stops = read_gtfs(spark, source, "stops")
        timetable = build_timetable(ws, calendar, trips, stop_calls(read_gtfs(spark, source, "stop_times")), stops)
        write_calls_by_day(timetable, f"{target}/stop_times", rows_per_file)
        write_days(transfers_by_day(timetable), f"{target}/transfers", "from_stop_id", rows_per_file)
        write_days(stops_by_day(timetable), f"{target}/stops", "stop_id", rows_per_file)
        dates = read_gtfs(spark, source, "calendar_dates") if path_exists(spark, f"{source}/calendar_dates.txt") else None
        headsigns = timetable.patterns.select("trip_id").join(trips.select("trip_id", "trip_headsign"), "trip_id")
        publish_network(
            ws, f"{target}/network", timetable.calls, network_services(timetable.services, calendar, dates),
            timetable.stops.select("stop_id", "stop_name"), timetable.transfers, headsigns,
        )
        forget_network(spark, f"{target}/network")
    finally:
        ws.drop()
