"""Fusion, reports, features and forecast on small hand-made tables."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from headway.operators import features, fusion, reports
from headway.operators.search import stop_search
from headway.plans import forecast
from headway.schemas import REALTIME_TABLES

DAY = 19_000 * 86_400  # 2022-01-08
SCHEDULE = (
    "trip_id string, route_id string, service_id string, direction_id int, sch_arrival_secs int, "
    "sch_departure_secs int, stop_id string, stop_sequence int, stop_name string, stop_lat double, stop_lon double"
)
STOPS = REALTIME_TABLES["stops"][0]


def schedule(spark, *places):
    """(trip, stop, sequence, seconds, route, direction)"""
    return spark.createDataFrame(
        [(t, r, "1", d, at, at, s, n, f"Stop {s}", 49.0, -123.0) for t, s, n, at, r, d in places], SCHEDULE
    )


def updates(spark, *lines):
    """(stop, trip, arrival delay or None, departure delay); scheduled at 600."""
    return spark.createDataFrame(
        [
            (s, t, 1, -1 if a is None else a, -1 if a is None else DAY + 600 + a, d, DAY + 630 + d, DAY)
            for s, t, a, d in lines
        ],
        STOPS,
    )


def test_fusion_keeps_ties_and_cleans_sentinels(spark):
    static = schedule(spark, ("t1", "a", 1, 600, "R1", 1), ("t2", "a", 1, 600, "R2", 0))
    live = updates(spark, ("a", "t1", 60, 1), ("a", "t1", 60, 2), ("a", "t1", 30, 3), ("a", "t1", None, 4), ("a", "t2", None, 5), ("zz", "t1", 9, 9))
    fused = fusion.fuse(static, live)
    assert tuple(fused.columns) == fusion.FUSED_COLUMNS
    assert fused.count() == 5
    sentinel = fused.filter("departure_delay = 4").first()
    assert (sentinel.arrival_delay, sentinel.arrival_time, sentinel.sch_arrival_time) == (None, None, None)
    assert (sentinel.trip_date, sentinel.sch_departure_time) == ("01-08-2022", DAY + 630)
    top = fusion.fuse_max_delay(static, live)
    assert rows(top, "trip_id", "arrival_delay", "departure_delay") == [("t1", 60, 1), ("t1", 60, 2), ("t2", None, 5)]
    assert rows(top.filter("trip_id = 't1'"), "sch_arrival_time", "trip_date")[0] == (DAY + 600, "01-08-2022")
    one = fusion.fuse_max_delay(static, live, one_row=True)
    assert rows(one, "trip_id", "departure_delay") == [("t1", 2), ("t2", 5)]
    route = fusion.fuse_max_delay(static, live, "R2", 0, compat=True).first()
    assert (route.arrival_delay, route.arrival_time, route.sch_arrival_time) == (-1, DAY + 635, 0)
    assert fusion.fuse(static, live, "R2", 1).count() == 0


def test_reports(spark):
    static = schedule(spark, ("t1", "a", 1, 600, "R1", 1), ("t2", "b", 1, 600, "R2", 0))
    live = updates(spark, ("a", "t1", 60, 10), ("b", "t2", 20, 30))
    fused = fusion.fuse(static, live)
    assert [tuple(r) for r in reports.delay_by_stop(fused).collect()] == [("b", 30.0), ("a", 10.0)]
    assert rows(reports.delay_by_stop_time(fused)) == [("Stop a", 1, 1, 8, 0, 60.0), ("Stop b", 1, 1, 8, 0, 20.0)]
    assert [tuple(r) for r in reports.delay_arrival_departure(fused).collect()] == [("Stop a", 60.0, 10.0), ("Stop b", 20.0, 30.0)]
    rt_trips = spark.createDataFrame(
        [("t1", "20220108", "R1", 1, 5), ("t1", "20220108", "R1", 1, 6), ("t2", "20220108", "R2", 0, 5)], REALTIME_TABLES["trips"][0]
    )
    assert rows(reports.delay_by_route_direction(live, rt_trips)) == [("R1", 1, 10.0), ("R2", 0, 30.0)]
    alerts = spark.createDataFrame(
        [("A1", "R1", 1, 2, "s", 3, 4, 1, 1, 3), ("A2", "R1", 1, 2, "s", 3, 4, 1, 1, 2), ("A3", "R2", 1, 2, "s", 3, 4, 1, 1, 4),
         ("A4", "R3", 1, 2, "s", 3, 4, 1, 1, 4), ("A5", "R4", 1, 2, "s", 3, 4, 1, 1, 4)], REALTIME_TABLES["alerts"][0]
    )
    routes = spark.createDataFrame(
        [("R1", "001", "One"), ("R2", "002", "Two"), ("R3", "003", None), ("R4", "004", "No trips")],
        "route_id string, route_short_name string, route_long_name string",
    )
    assert [tuple(r) for r in reports.alerts_by_route(alerts, routes, rt_trips).collect()] == [
        ("R2", "Two", "002", 1, 4), ("R1", "One", "001", 2, 2)
    ]


@pytest.mark.parametrize("values", [[5], [1, 2], [1, 2, 10], [7, 7, 7, 7], [-3, 100_000, 4, 4, 2_000_000], None])
def test_exact_median(spark, values):
    values = values or [random.Random(4).randrange(-900, 70_000) for _ in range(501)] + [None] * 7
    df = spark.createDataFrame([(v,) for v in values], "v int")
    known = [v for v in values if v is not None]
    assert features.exact_median(df, "v").first()[0] == statistics.median(known)


def test_outliers(spark):
    df = spark.createDataFrame([(1,), (2,), (10,), (None,)], "arrival_delay int")
    assert rows(features.replace_outliers(df)) == [(1.0,), (2.0,), (2.0,), (None,)]


def test_running_time_stays_inside_a_trip(spark, ws):
    df = spark.createDataFrame(
        [("t1", "d", "a", 1, 100), ("t1", "d", "b", 2, 160), ("t1", "d", "c", 4, 300), ("t2", "d", "a", 2, 130), ("t1", "e", "b", 2, 900)],
        "trip_id string, trip_date string, stop_id string, stop_sequence int, arrival_time long",
    )
    wanted = [("t1", "d", 1, 0), ("t1", "d", 2, 60), ("t1", "d", 4, 140), ("t1", "e", 2, 0), ("t2", "d", 2, 0)]
    columns = ("trip_id", "trip_date", "stop_sequence", "running_time")
    assert rows(features.running_time(ws, df), *columns) == wanted
    assert rows(features.running_time(ws, df, rows_per_task=1), *columns) == wanted


def series(spark, lengths, value=lambda key, i: float(i)):
    lines = [
        (key, 0, f"t{i}", "d", "s", 1, DAY + 100 * i, value(key, i), DAY + 100 * i, float(i % 3))
        for key, n in lengths.items() for i in range(n)
    ]
    return spark.createDataFrame(
        lines,
        "route_id string, direction_id int, trip_id string, trip_date string, stop_id string, stop_sequence int, "
        "sch_arrival_time long, arrival_delay double, arrival_time long, running_time double",
    )


def test_short_series_and_tail_split(spark, ws):
    data = series(spark, {"R1": 14, "R2": 15, "R3": 44})
    lagged = features.lag_features(ws, data)
    counts = dict(rows(lagged.groupBy("route_id").count()))
    assert counts == {"R2": 1, "R3": 30}
    first = lagged.filter("route_id = 'R2'").first()
    assert (first.arrival_delay, first.arrival_delay_1, first.arrival_delay_14) == (14.0, 13.0, 0.0)
    marked = features.mark_test_rows(lagged, data)
    assert rows(marked.filter("is_test"), "route_id", "position") == [("R3", 42), ("R3", 43), ("R3", 44)]
    scaled = features.minmax_scale(marked, marked.filter("not is_test"))
    top = scaled.filter("route_id = 'R3'").agg(F.max("arrival_delay_scaled")).first()[0]
    assert abs(top - (43 - 14) / (40 - 14)) < 1e-9


def test_next_call_rolls_over_to_the_next_trip(spark, ws):
    static = schedule(
        spark, ("9", "a", 1, 10, "R", 0), ("9", "b", 3, 20, "R", 0), ("10", "a", 1, 5, "R", 0), ("10", "c", 2, 15, "R", 0), ("3", "z", 1, 1, "R", 1)
    )
    wanted = [("10", 1, "10", 2), ("10", 2, "9", 1), ("3", 1, "3", 1), ("9", 1, "9", 3), ("9", 3, "10", 1)]
    for limit in (1_000_000, 2):
        numbered = forecast.number_calls(ws, static, limit)
        got = rows(forecast.next_calls(numbered), "trip_id", "stop_sequence", "next_trip_id", "next_stop_sequence")
        assert got == wanted


def wave(key, i):
    return 3 * math.sin(i / 2) + (1 if key == "R1" else 0)


def test_model_beats_the_mean_on_a_planted_signal(spark, ws):
    supervised = forecast.supervised_rows(ws, series(spark, {"R1": 120, "R2": 90}, wave))
    model = forecast.fit(supervised)
    error = forecast.forecast_error(model, supervised).first()
    assert error.rows == 10 + 7 and error.mae < 0.2 * error.mean_mae


def test_recursive_forecast_equals_a_plain_loop(spark, ws):
    """The fold over the next calls against the same recursion in numpy, past midnight."""
    lengths = {"R1": 60, "R2": 40, "R3": 5}
    data = series(spark, lengths, wave)
    model = forecast.fit(forecast.supervised_rows(ws, data))
    calls = [(f"t{i}", "s", 1, 86_000 + 100 * i if i < 4 else 100 * i, k, 0) for k, n in lengths.items() for i in range(n)]
    static = schedule(spark, *calls)
    # The stored schedule of a record is its scheduled time on the day it belongs to.
    secs = {(k, t): at for t, _, _, at, k, _ in calls}
    numbered = forecast.number_calls(ws, static)
    trips = spark.createDataFrame([(f"t{i}", f"Head {i}") for i in range(60)], "trip_id string, trip_headsign string")
    got = forecast.forecast_next_stops(model, data, numbered, trips, stops=6).collect()
    assert {r.route_id for r in got} == {"R1", "R2"} and len(got) == 12

    def scale(value, f):
        return (value - model.low[f]) / (model.high[f] - model.low[f])

    for key in ("R1", "R2"):
        n = lengths[key]
        history = [
            [scale(wave(key, i), "arrival_delay"), scale(DAY + 100 * i, "arrival_time"), scale(i % 3, "running_time")]
            for i in range(n - 14, n)
        ]
        order = sorted((f"t{i}" for i in range(n)), key=lambda t: (len(t), t))
        at, before = order.index(f"t{n - 1}"), DAY + 100 * (n - 1)
        last_secs = secs[key, f"t{n - 1}"]
        day = DAY + 100 * (n - 1) - last_secs
        for step, row in enumerate(sorted((r for r in got if r.route_id == key), key=lambda r: r.step), 1):
            flat = np.array(history).ravel()
            scaled = model.intercept + flat @ np.array(model.weights)
            delay = model.low["arrival_delay"] + scaled * (model.high["arrival_delay"] - model.low["arrival_delay"])
            trip = order[(at + step) % n]
            if secs[key, trip] < last_secs:
                day += 86_400
            last_secs = secs[key, trip]
            scheduled = day + last_secs
            arrival = scheduled + delay * 60
            history = history[1:] + [[scale(delay, "arrival_delay"), scale(arrival, "arrival_time"), scale(arrival - before, "running_time")]]
            before = arrival
            assert row.trip_name == f"Head {trip[1:]}" and row.step == step
            assert abs(row.delay - delay) < 1e-6 * max(1, abs(delay))
            assert row.scheduled_time == str(np.datetime64(scheduled, "s")).replace("T", " ")


NAMES = ["Main St", "Main St Station", "MAIN", "Oak", "Oak Bay", "x", "Bay"]


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_stop_search_equals_a_scan(spark, ws, limit):
    stops = spark.createDataFrame(
        [(str(i), name) for i, name in enumerate(NAMES)] + [("12", "Oak")], "stop_id string, stop_name string"
    )
    terms = ["main", "St", "a", "", "BAY", "main st s", "zzz", "in S", "oak bay and more"]
    found = stop_search(ws, stops, spark.createDataFrame(list(enumerate(terms)), "term_id int, term string"), 3, limit)
    ids = {name: str(i) for i, name in enumerate(NAMES)} | {"Oak": "12"}
    wanted = []
    for i, term in enumerate(terms):
        hits = sorted((n for n in set(NAMES) if term.lower() in n.lower()), key=lambda n: (len(n), n))
        wanted += [(i, rank, ids[n], n) for rank, n in enumerate(hits[:3], 1)]
    assert rows(found) == sorted(wanted, key=repr)


def test_calls_without_a_direction_keep_their_next_call(spark, ws):
    static = schedule(spark, ("1", "a", 1, 10, "R", None), ("1", "b", 2, 20, "R", None), ("2", "a", 1, 5, "R", 0))
    got = rows(forecast.next_calls(forecast.number_calls(ws, static)), "trip_id", "stop_sequence", "next_stop_sequence")
    assert got == [("1", 1, 2), ("1", 2, 1), ("2", 1, 1)]
