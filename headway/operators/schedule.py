"""Which services, trips, calls and stops run, and the pattern each trip follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.times import DAY_SECS, service_date
from headway.schemas import WEEKDAYS


def services_by_day(calendar: DataFrame) -> DataFrame:
    """``(day, service_id)`` for every weekday flag that is set, in one scan."""
    flags = F.array(
        *[F.struct(F.lit(day).alias("day"), F.col(day).alias("runs")) for day in WEEKDAYS]
    )
    return calendar.select("service_id", F.inline(flags)).filter("runs = 1").select("day", "service_id")


def services_by_date(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """``(service_date, service_id)``: weekday flags within the date range, with the listed
    additions (1) and removals (2) applied."""
    first, last = service_date(F.col("start_date")), service_date(F.col("end_date"))
    flags = F.array(*[F.col(day) for day in WEEKDAYS])
    regular = (
        calendar.filter(first <= last)
        .select("service_id", flags.alias("flags"), F.explode(F.sequence(first, last)).alias("service_date"))
        .filter(F.element_at("flags", F.weekday("service_date") + 1) == 1)
        .select("service_date", "service_id")
    )
    changes = calendar_dates.select(
        service_date(F.col("date")).alias("service_date"), "service_id", "exception_type"
    )
    keys = ["service_date", "service_id"]
    added = changes.filter("exception_type = 1").select(keys)
    removed = changes.filter("exception_type = 2").select(keys)
    return regular.join(removed, keys, "left_anti").unionByName(added).distinct()


def calendar_days(calendar: DataFrame) -> DataFrame:
    """Every date from the first start to the last end."""
    span = calendar.agg(
        F.min(service_date(F.col("start_date"))).alias("first"),
        F.max(service_date(F.col("end_date"))).alias("last"),
    )
    return span.select(F.explode(F.sequence("first", "last")).alias("sch_date"))


def trips_in_service(trips: DataFrame, services: DataFrame) -> DataFrame:
    return trips.join(services.select("service_id"), "service_id", "left_semi")


def same_day_calls(calls: DataFrame) -> DataFrame:
    """Calls that arrive before midnight of the service day."""
    return calls.filter(F.col("arr_secs") < DAY_SECS)


def departure_window(calls: DataFrame, departure_secs: int, window_secs: int = 3600) -> DataFrame:
    """Calls that arrive in ``[departure, departure + window)``."""
    arrival = F.col("arr_secs")
    return calls.filter((arrival >= departure_secs) & (arrival < departure_secs + window_secs))


def trip_patterns(calls: DataFrame, trips: DataFrame) -> DataFrame:
    """``(trip_id, route_id, service_id, calls, pattern)``: trips of a route with the same
    stops at the same places share a pattern.

    The fingerprint adds up four 32-bit pieces of each call's digest, so it needs neither
    a sort nor a list of the trip's calls and combines on the map side.
    """
    digest = F.md5(F.concat_ws("@", F.col("stop_sequence").cast("string"), "stop_id"))
    pieces = [
        F.sum(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")).alias(f"_piece_{i}")
        for i in range(4)
    ]
    prints = calls.groupBy("trip_id").agg(F.count(F.lit(1)).alias("calls"), *pieces)
    fingerprint = F.md5(
        F.concat_ws(",", F.col("calls").cast("string"), *[F.col(f"_piece_{i}").cast("string") for i in range(4)])
    )
    return (
        trips.select("trip_id", "route_id", "service_id")
        .join(prints, "trip_id")
        .select(
            "trip_id",
            "route_id",
            "service_id",
            "calls",
            F.concat_ws("--", "route_id", fingerprint).alias("pattern"),
        )
    )


def served_stops(stops: DataFrame, calls: DataFrame) -> DataFrame:
    return stops.join(calls.select("stop_id"), "stop_id", "left_semi")


def static_schedule(trips: DataFrame, calls: DataFrame, stops: DataFrame) -> DataFrame:
    return (
        calls.join(trips.select("trip_id", "route_id", "service_id", "direction_id"), "trip_id")
        .join(stops, "stop_id")
        .select(
            "trip_id",
            "route_id",
            "service_id",
            "direction_id",
            F.col("arr_secs").alias("sch_arrival_secs"),
            F.col("dep_secs").alias("sch_departure_secs"),
            "stop_id",
            "stop_sequence",
            "stop_name",
            "stop_lat",
            "stop_lon",
        )
    )


def route_trips(trips: DataFrame, route_id: str, direction_id: int) -> DataFrame:
    return trips.filter((F.col("route_id") == route_id) & (F.col("direction_id") == direction_id))


def trip_lengths(calls: DataFrame) -> DataFrame:
    return calls.groupBy("trip_id").agg(F.max("stop_sequence").alias("last_sequence"))
