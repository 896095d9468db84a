"""The tables that the queries derive from the given ones, beside plain forms of them."""

import pytest
from pyspark.sql import functions as F

from catalogue import queries
from catalogue.views import Views
from conftest import rows
from headway.operators.features import delay_series
from headway.operators.schedule import static_schedule
from headway.sources.workspace import dealt_alike, list_folders

LINES = [
    # Order 1 meets supplier 5 on lines 2 and 4, and one line has no supplier.
    (1, 9, 1), (1, 5, 2), (1, 7, 2), (1, 5, 4), (1, None, 3), (1, 4, 5),
    (2, 5000, 1), (2, 3, 1), (2, 4999, 1), (2, 3, 2), (2, 8, None), (3, 6, 1), (3, 6, 1), (None, 6, 1), (4, 1, 1),
]


@pytest.fixture
def folder(spark, tmp_path):
    lines = spark.createDataFrame(LINES, "l_orderkey long, l_suppkey long, l_linenumber int").withColumns(
        {"l_quantity": F.col("l_linenumber").cast("double") + 20, "l_tax": F.lit(0.02)}
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.createDataFrame([(1, "2024-01-08"), (2, "2024-01-09"), (3, "2024-01-10"), (3, "2024-01-11")], "o_orderkey long, day string")
    orders.select("o_orderkey", F.col("day").cast("date").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


# Of every trip its stops in order: least line first, then the supplier; a line without one takes a number.
CALLS = [
    ("1", "9", 1), ("1", "5", 2), ("1", "7", 3), ("1", "4", 5),
    ("2", "3", 2), ("2", "4999", 3), ("2", "5000", 4), ("3", "6", 1), ("4", "1", 1),
]


def test_calls_of_orders_in_one_task_and_of_long_ones(spark, folder):
    wanted = sorted(CALLS, key=repr)
    assert rows(Views(spark, folder).calls, "trip_id", "stop_id", "stop_sequence") == wanted
    # Every order with more than two lines is long.
    assert rows(Views(spark, folder, rows_per_task=2).calls) == rows(Views(spark, folder).calls)


def test_realtime_rows_carry_the_call_of_their_line(spark, folder):
    views = Views(spark, folder)
    got = views.rt_stops
    numbers = {(trip, stop): number for trip, stop, number in CALLS}
    lines = [(str(order), str(stop)) for order, stop, line in LINES if order and stop and (str(order), str(stop)) in numbers]
    dates = {"1": 1, "2": 1, "3": 2, "4": 0}
    wanted = [(trip, stop, numbers[trip, stop]) for trip, stop in lines for _ in range(dates[trip])]
    assert rows(got, "trip_id", "stop_id", "stop_sequence") == sorted(wanted, key=repr)
    assert rows(Views(spark, folder, rows_per_task=2).rt_stops) == rows(got)


def test_lines_are_shuffled_once(spark, folder):
    """Lines get their calls where the order's lines are; before, lines and calls were shuffled to each other."""
    text = Views(spark, folder).rt_stops._jdf.queryExecution().executedPlan().toString()
    assert text.count("l_suppkey:bigint") == 1 and "arr_secs:" not in text
    assert "stop_id" not in "".join(line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_only_the_network_stays_of_its_preparation(spark):
    views = Views(spark, "/root/testdata/sf0.001", rows_per_task=999_999)
    assert views.network.stops.count() > 0
    kept = views._stored_once("network", lambda ws: None)
    assert list_folders(spark, kept) == ["network"]


def test_calls_and_realtime_rows_of_a_series_are_dealt_by_order_only(spark):
    """The join by stop and order finds both sides dealt by order; a long order is left to the plain plan."""
    views = Views(spark, "/root/testdata/sf0.001")
    records = queries._records(views, static_schedule(views.trips, views.calls_by_order, views.stops))
    with dealt_alike(spark):
        plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(trip_id" in plan and "Exchange hashpartitioning(stop_id" not in plan
    assert rows(records) == rows(queries._records(views), *records.columns)
    assert Views(spark, "/root/testdata/sf0.001", rows_per_task=6).calls_by_order._jdf.queryExecution().toString().count("RepartitionByExpression") == 0


def test_only_the_series_stays_of_its_preparation(spark, ws):
    records = queries._records(Views(spark, "/root/testdata/sf0.001"))
    series = delay_series(ws, records, rows_per_task=100)
    assert list_folders(spark, ws.folder) == ["001-series"] and series.count() > 4000
