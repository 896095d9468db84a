"""Registered queries: each runs an operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.views import Views
from headway.functions.times import clock_text
from headway.operators import features, fusion, merge, reports, schedule
from headway.operators.search import stop_search
from headway.operators.transfers import walking_transfers
from headway.plans import forecast, journeys, routing, timetable
from headway.plans.network import Network
from headway.schemas import ALERT_FEED, MISSING, REALTIME_TABLES, TRIP_FEED
from headway.sources import feeds, gtfs
from headway.sources.keyed import KeyedTable
from headway.sources.workspace import dealt_alike
from headway.streaming.ingest import suppress_duplicates

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

VISIT = ("trip_id", "stop_id", "trip_date")


def _query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, folder: build(Views(spark, folder))
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(column: str, digits: int = 6):
    return F.round(column, digits).alias(column)


# --- schedule -----------------------------------------------------------------------


@_query
def services_by_day(v: Views) -> DataFrame:
    running = v.trips.groupBy("service_id").agg(F.count(F.lit(1)).alias("trips"))
    return schedule.services_by_day(v.calendar).join(running, "service_id").select("day", "service_id", "trips")


@_query
def services_by_date(v: Views) -> DataFrame:
    return schedule.services_by_date(v.calendar, v.calendar_dates).select(
        F.date_format("service_date", "yyyyMMdd").alias("service_date"), "service_id"
    )


@_query
def calendar_days(v: Views) -> DataFrame:
    return schedule.calendar_days(v.calendar).select(F.date_format("sch_date", "yyyyMMdd").alias("sch_date"))


@_query
def trips_in_service(v: Views) -> DataFrame:
    saturday = schedule.services_by_day(v.calendar).filter("day = 'saturday'")
    running = schedule.trips_in_service(v.trips, saturday)
    return v.calls.join(running, "trip_id", "left_semi").select("trip_id", "stop_id", "stop_sequence")


@_query
def stops_in_service(v: Views) -> DataFrame:
    return timetable.stops_by_day(v.timetable)


@_query
def stop_times_same_day(v: Views) -> DataFrame:
    return schedule.same_day_calls(v.calls)


@_query
def departure_window(v: Views) -> DataFrame:
    return schedule.departure_window(v.calls, 14 * 3600 + 1800)


@_query
def trip_patterns(v: Views) -> DataFrame:
    return schedule.trip_patterns(schedule.same_day_calls(v.calls), v.trips)


@_query
def trips_per_pattern(v: Views) -> DataFrame:
    return (
        trip_patterns(v)
        .groupBy("route_id", "pattern")
        .agg(F.min("trip_id").alias("first_trip_id"), F.count(F.lit(1)).alias("trips"), F.max("calls").alias("calls"))
        .drop("pattern")
    )


@_query
def trip_length(v: Views) -> DataFrame:
    return schedule.trip_lengths(v.calls)


@_query
def route_direction_trips(v: Views) -> DataFrame:
    return schedule.route_trips(v.trips, "R7", 1).select("trip_id", "route_id", "direction_id", "service_id")


@_query
def static_schedule(v: Views) -> DataFrame:
    return _schedule(v).withColumns({"stop_lat": F.round("stop_lat", 6), "stop_lon": F.round("stop_lon", 6)})


@_query
def schedule_round_trip(v: Views) -> DataFrame:
    """The schedule written as GTFS text and read back with its fixed types."""
    folder = f"{v.ws.folder}/gtfs"
    timed = v.calls.withColumns({"arrival_time": clock_text(F.col("arr_secs")), "departure_time": clock_text(F.col("dep_secs"))})
    for table, rows in (("trips", v.trips), ("stops", v.stops), ("stop_times", timed)):
        gtfs.write_gtfs(rows, folder, table)
    trips, stops, times = (gtfs.read_gtfs(v.spark, folder, table) for table in ("trips", "stops", "stop_times"))
    found = schedule.static_schedule(trips, gtfs.stop_calls(times), stops)
    return found.withColumns({"stop_lat": F.round("stop_lat", 6), "stop_lon": F.round("stop_lon", 6)})


@_query
def stored_days(v: Views) -> DataFrame:
    """Sorted files of every day written and read back: the calls and trips of each day and hour."""
    folder = f"{v.ws.folder}/days/stop_times"
    timetable.write_calls_by_day(v.timetable, folder)
    hour = F.floor(F.col("arr_secs") / 3600).cast("int").alias("hour")
    return v.spark.read.parquet(folder).groupBy("day", hour).agg(
        F.count(F.lit(1)).alias("calls"), F.countDistinct("trip_id").alias("trips"), F.countDistinct("stop_id").alias("stops")
    )


@_query
def distinct_sequences(v: Views) -> DataFrame:
    return _schedule(v).select("stop_sequence").distinct()


def _schedule(v: Views) -> DataFrame:
    return schedule.static_schedule(v.trips, v.calls, v.stops)


@_query
def walking_transfers_between_stops(v: Views) -> DataFrame:
    return walking_transfers(v.ws, v.stops).select(
        "from_stop_id", "to_stop_id", _rounded("distance"), _rounded("transfer_time")
    )


_QUERIES["walking_transfers"] = _QUERIES.pop("walking_transfers_between_stops")


@_query
def timetable_calls(v: Views) -> DataFrame:
    return timetable.calls_by_day(v.timetable)


@_query
def timetable_transfers(v: Views) -> DataFrame:
    return timetable.transfers_by_day(v.timetable).select(
        "day", "from_stop_id", "to_stop_id", _rounded("transfer_time")
    )


@_query
def scan_day_partition(v: Views) -> DataFrame:
    folder = f"{v.ws.folder}/days/stop_times"
    timetable.write_calls_by_day(v.timetable, folder)
    return gtfs.read_day(v.spark, folder, "sunday").select(
        "day", "trip_id", "stop_id", "stop_sequence", "arr_secs", "dep_secs"
    )


# --- journeys -----------------------------------------------------------------------


def _first_boardable(v: Views) -> DataFrame:
    limits = routing.search_limits(v.network, v.searches)
    return routing.boardable_calls(v.network, limits, routing.start_labels(v.network, v.searches))


def _named(network: Network, df: DataFrame, **stops: str) -> DataFrame:
    return routing.name_trips(network, routing.name_stops(network, df, **stops))


@_query
def boardable_calls(v: Views) -> DataFrame:
    calls = _first_boardable(v).select("query_id", "trip_no", "stop_no", "stop_sequence", "dep_secs")
    return _named(v.network, calls, stop_no="stop_id")


@_query
def earliest_trip_per_pattern(v: Views) -> DataFrame:
    return _named(v.network, routing.earliest_trip_per_pattern(_first_boardable(v)), stop_no="stop_id")


@_query
def downstream_stops(v: Views) -> DataFrame:
    onward = routing.downstream_stops(v.network, routing.boardings(_first_boardable(v), v.network))
    return _named(v.network, onward.drop("board_dep_secs"), stop_no="stop_id", board_no="board_stop")


def _first_candidates(v: Views) -> DataFrame:
    start = routing.start_labels(v.network, v.searches)
    onward = routing.downstream_stops(v.network, routing.boardings(_first_boardable(v), v.network))
    rides = routing.best_rides(onward).join(start.select("query_id", "stop_no"), ["query_id", "stop_no"], "left_anti")
    return routing.reach_on_foot(v.network, rides, start).drop("board_dep_secs", "alight_secs")


def _named_candidates(network: Network, candidates: DataFrame) -> DataFrame:
    stops = {"stop_no": "stop_id", "board_no": "board_stop", "alight_no": "alight_stop"}
    return routing.name_modes(_named(network, candidates, **stops))


@_query
def footpath_relax(v: Views) -> DataFrame:
    return _named_candidates(v.network, _first_candidates(v).filter(F.col("mode") != routing.RIDE))


@_query
def candidate_union(v: Views) -> DataFrame:
    return _named_candidates(v.network, _first_candidates(v))


def _arrivals(v: Views, searches: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    return routing.search_in_portions(
        v.ws, v.network, searches, lambda labels, _, goals: routing.earliest_arrivals(v.network, labels, goals), wanted
    )


@_query
def earliest_arrivals(v: Views) -> DataFrame:
    return _arrivals(v, v.searches)


@_query
def arrivals_at_destinations(v: Views) -> DataFrame:
    """Searches and destinations of all customers; rows grow with the customers alone."""
    return _arrivals(v, v.customer_searches, v.customer_destinations)


@_query
def arrivals_by_date(v: Views) -> DataFrame:
    return _arrivals(v, v.dated_searches)


@_query
def reachable_by_round(v: Views) -> DataFrame:
    return routing.search_in_portions(v.ws, v.network, v.searches, lambda labels, *_: routing.reachable_by_round(labels))


def _to_destinations(v: Views, answer: routing.Answer) -> DataFrame:
    return routing.search_in_portions(v.ws, v.network, v.searches, answer, v.destinations)


@_query
def journey_legs(v: Views) -> DataFrame:
    return _to_destinations(v, lambda labels, _, goals: journeys.journey_legs(v.network, labels, goals))


@_query
def journeys_to_destinations(v: Views) -> DataFrame:
    found = _to_destinations(v, lambda labels, some, goals: journeys.journeys(v.network, labels, some, goals, v.stops))
    return found.withColumns({c: F.concat_ws("|", c) for c in ("trip", "hops", "hop_names")})


@_query
def best_journeys(v: Views) -> DataFrame:
    stops, trips = v.network.stops, v.network.trips
    return _to_destinations(v, lambda labels, some, goals: journeys.best_journeys(v.network, labels, some, goals, stops, trips))


@_query
def journeys_by_name(v: Views) -> DataFrame:
    return journeys.journeys_by_name(v.ws, v.network, v.named_requests, v.network.stops, v.network.trips)


@_query
def stop_search_by_name(v: Views) -> DataFrame:
    return stop_search(v.ws, v.stops, v.search_terms)


_QUERIES["stop_search"] = _QUERIES.pop("stop_search_by_name")


# --- realtime -----------------------------------------------------------------------


def _trip_messages(v: Views) -> DataFrame:
    """Realtime rows as feed messages in JSON text; each carries an empty update as well."""

    def present(column: str):
        return F.when(F.col(column) != MISSING, F.col(column))

    def event(kind: str):
        timed = F.struct(F.col(f"{kind}_delay").alias("delay"), F.col(f"{kind}_time").alias("time"))
        return F.when(F.col(f"{kind}_time") != MISSING, timed).alias(kind)

    update = F.struct("stop_sequence", "stop_id", event("arrival"), event("departure"))
    nothing = F.lit(None).cast(
        "struct<stop_sequence int, stop_id string, arrival struct<delay int, time bigint>, "
        "departure struct<delay int, time bigint>>"
    )
    rows = v.rt_stops.join(v.trips.select("trip_id", "start_date", "route_id", "direction_id"), "trip_id")
    body = F.struct(
        present("snapshot_ts").alias("timestamp"),
        F.struct("trip_id", "start_date", "route_id", "direction_id").alias("trip"),
        F.array(update, nothing).alias("stop_time_update"),
        F.struct(F.col("trip_id").alias("id"), F.concat(F.lit("V"), "trip_id").alias("label")).alias("vehicle"),
    )
    entity = F.struct(F.col("trip_id").alias("id"), body.alias("trip_update"))
    message = F.struct(F.struct(F.col("snapshot_ts").alias("timestamp")).alias("header"), F.array(entity).alias("entity"))
    return feeds.parse_feed(rows.select(F.to_json(message).alias("json")), "json", TRIP_FEED)


@_query
def feed_json_flatten(v: Views) -> DataFrame:
    return feeds.feed_stops(_trip_messages(v))


@_query
def feed_trip_rows(v: Views) -> DataFrame:
    return feeds.feed_trips(_trip_messages(v))


@_query
def feed_vehicle_rows(v: Views) -> DataFrame:
    return feeds.feed_vehicles(_trip_messages(v))


@_query
def ingest_counts(v: Views) -> DataFrame:
    return feeds.feed_counts(_trip_messages(v))


def _alert_messages(v: Views) -> DataFrame:
    """Alerts as feed messages in JSON text; each informs an entity without a route as well."""
    end = F.when(F.col("active_period_end") != MISSING, F.col("active_period_end"))
    stop = F.when(F.col("stop_id") != str(MISSING), F.col("stop_id"))
    informed = F.struct("route_type", "route_id", stop.alias("stop_id"))
    routeless = F.struct("route_type", F.lit(None).cast("string").alias("route_id"), F.lit("9").alias("stop_id"))
    body = F.struct(
        F.array(F.struct(F.col("active_period_start").alias("start"), end.alias("end"))).alias("active_period"),
        "cause", "effect", "severity_level",
        F.array(informed, routeless).alias("informed_entity"),
    )
    entity = F.struct(F.col("alert_id").alias("id"), body.alias("alert"))
    message = F.struct(F.struct(F.col("snapshot_ts").alias("timestamp")).alias("header"), F.array(entity).alias("entity"))
    texts = v.alerts.select(F.to_json(message).alias("json"))
    return feeds.parse_feed(texts, "json", ALERT_FEED)


@_query
def alert_entities(v: Views) -> DataFrame:
    return feeds.feed_alerts(_alert_messages(v))


@_query
def alert_ingest_counts(v: Views) -> DataFrame:
    return feeds.alert_counts(_alert_messages(v))


def _realtime(v: Views) -> dict[str, DataFrame]:
    return {"trips": v.rt_trips, "stops": v.rt_stops, "vehicles": v.rt_vehicles, "alerts": v.alerts}


def _upserted(v: Views, table: str) -> DataFrame:
    return merge.latest_by_key(_realtime(v)[table], REALTIME_TABLES[table][1])


@_query
def rt_upsert_trips(v: Views) -> DataFrame:
    return _upserted(v, "trips")


@_query
def rt_upsert_stops(v: Views) -> DataFrame:
    return _upserted(v, "stops")


@_query
def rt_upsert_vehicles(v: Views) -> DataFrame:
    return _upserted(v, "vehicles")


@_query
def alerts_upsert(v: Views) -> DataFrame:
    return _upserted(v, "alerts")


@_query
def rt_upsert_batches(v: Views) -> DataFrame:
    """Four batches of alerts merged one after the other, the first one twice."""
    table = KeyedTable(v.spark, f"{v.ws.folder}/alerts", *REALTIME_TABLES["alerts"], buckets=8)
    for number in (0, 1, 0, 2, 3):
        table.merge(v.alert_batches.filter(F.col("batch") == number), number)
    return table.read()


@_query
def rt_dedup_batch(v: Views) -> DataFrame:
    return suppress_duplicates(v.rt_stops, "stops")


@_query
def key_violations(v: Views) -> DataFrame:
    checks = [
        merge.key_violations(rows, REALTIME_TABLES[name][1])
        .agg(F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "repeated_keys", "row_count")
        for name, rows in _realtime(v).items()
    ]
    return reduce(DataFrame.unionByName, checks)


@_query
def rt_bottom_k_delay(v: Views) -> DataFrame:
    return merge.bottom_k(v.rt_stops, "arrival_delay", 10_000)


@_query
def clean_sentinels(v: Views) -> DataFrame:
    return features.drop_missing(fusion.clean_sentinels(v.rt_stops))


# --- fusion and reports -------------------------------------------------------------


def _near(df: DataFrame) -> DataFrame:
    return df.withColumns({"stop_lat": F.round("stop_lat", 6), "stop_lon": F.round("stop_lon", 6)})


@_query
def fused_delays(v: Views) -> DataFrame:
    return _near(fusion.fuse(_schedule(v), v.rt_stops))


def _history(v: Views) -> DataFrame:
    return fusion.fuse_max_delay(_schedule(v), v.rt_stops)


@_query
def fused_max_delay(v: Views) -> DataFrame:
    return _near(_history(v))


@_query
def fused_route_compat(v: Views) -> DataFrame:
    return _near(fusion.fuse_max_delay(_schedule(v), v.rt_stops, "R7", 1, compat=True))


@_query
def delay_by_stop(v: Views) -> DataFrame:
    return reports.delay_by_stop(_history(v)).withColumn("avg_departure_delay", F.round("avg_departure_delay", 4))


@_query
def delay_by_stop_time(v: Views) -> DataFrame:
    return reports.delay_by_stop_time(_history(v)).withColumn(
        "avg_arrival_delay", F.round("avg_arrival_delay", 4)
    )


@_query
def delay_arrival_departure(v: Views) -> DataFrame:
    return reports.delay_arrival_departure(_history(v)).withColumns(
        {c: F.round(c, 4) for c in ("avg_arrival_delay", "avg_departure_delay")}
    )


@_query
def alerts_by_route(v: Views) -> DataFrame:
    current = merge.latest_by_key(v.alerts, REALTIME_TABLES["alerts"][1])
    return reports.alerts_by_route(current, v.routes, v.rt_trips)


@_query
def delay_by_route_direction(v: Views) -> DataFrame:
    return reports.delay_by_route_direction(v.rt_stops, v.rt_trips).withColumn(
        "avg_departure_delay", F.round("avg_departure_delay", 4)
    )


# --- features and forecast ----------------------------------------------------------


def _records(v: Views, placed: DataFrame | None = None) -> DataFrame:
    fused = fusion.fuse_max_delay(_schedule(v) if placed is None else placed, v.rt_stops, one_row=True)
    return fused.join(v.trips.select("trip_id", "direction_id"), "trip_id")


def _series(v: Views) -> DataFrame:
    """The calls are dealt by order as the realtime rows are, which is the only time that both are shuffled."""
    records = _records(v, schedule.static_schedule(v.trips, v.calls_by_order, v.stops))
    with dealt_alike(v.spark):
        return features.delay_series(v.ws, records)


@_query
def delay_outliers(v: Views) -> DataFrame:
    records = v.ws.save(_records(v), "records")
    return features.replace_outliers(records).select(*VISIT, _rounded("arrival_delay"))


@_query
def running_time(v: Views) -> DataFrame:
    return features.running_time(v.ws, features.drop_missing(_records(v))).select(
        *VISIT, "stop_sequence", "arrival_time", F.col("running_time").cast("long").alias("running_time")
    )


@_query
def lag_features(v: Views) -> DataFrame:
    lagged = features.lag_features(v.ws, _series(v))
    delays = [_rounded(f"arrival_delay_{i}") for i in range(1, features.HISTORY_STEPS + 1)]
    others = [
        F.col(f"{f}_{i}").cast("long").alias(f"{f}_{i}")
        for f in ("arrival_time", "running_time")
        for i in range(1, features.HISTORY_STEPS + 1)
    ]
    return lagged.select(*VISIT, "position", _rounded("arrival_delay"), *delays, *others)


@_query
def train_test_split(v: Views) -> DataFrame:
    return forecast.supervised_rows(v.ws, _series(v)).select(*VISIT, "position", "is_test")


@_query
def minmax_scale(v: Views) -> DataFrame:
    supervised = forecast.supervised_rows(v.ws, _series(v))
    scaled = features.minmax_scale(supervised, supervised.filter("not is_test"))
    return scaled.select(*VISIT, *[_rounded(f"{f}_scaled") for f in features.FEATURES])


@_query
def next_calls(v: Views) -> DataFrame:
    return forecast.next_calls(forecast.number_calls(v.ws, _schedule(v)))


# A model that is given, so that SQL can follow it: the delay halves from call to call, with a little of
# the time and the running time. Oldest row first; delay, arrival time and running time of each.
FORECAST_WEIGHTS = [
    weight for step in range(features.HISTORY_STEPS, 0, -1) for weight in (0.5**step, 0.002, 0.05 / step)
]
FORECAST_INTERCEPT = 0.01


@_query
def forecast_mae(v: Views) -> DataFrame:
    supervised = forecast.supervised_rows(v.ws, _series(v))
    model = forecast.given_model(supervised, FORECAST_WEIGHTS, FORECAST_INTERCEPT)
    return forecast.forecast_error(model, supervised).select("rows", _rounded("mae"), _rounded("mean_mae"))


@_query
def forecast_next_stops(v: Views) -> DataFrame:
    series = _series(v)
    model = forecast.given_model(forecast.supervised_rows(v.ws, series), FORECAST_WEIGHTS, FORECAST_INTERCEPT)
    numbered = forecast.number_calls(v.ws, _schedule(v))
    return forecast.forecast_next_stops(model, series, numbered, v.trips).withColumn("delay", F.round("delay", 4))
