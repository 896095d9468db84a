"""The registered queries: what they claim, the shape of their plans, and their SQL checks."""

import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
REPO = os.path.dirname(os.path.abspath(entries.__file__))

CHECKED = (
    "services_by_day", "services_by_date", "calendar_days", "trips_in_service", "departure_window", "trip_patterns",
    "trips_per_pattern", "walking_transfers", "stop_search", "feed_json_flatten", "ingest_counts",
    "alert_entities", "rt_upsert_stops", "alerts_upsert", "key_violations", "rt_bottom_k_delay",
    "fused_max_delay", "fused_route_compat", "delay_by_stop", "alerts_by_route",
    "delay_by_route_direction", "delay_outliers", "running_time", "next_calls",
    "earliest_arrivals", "arrivals_at_destinations", "arrivals_by_date", "best_journeys", "journeys_by_name", "schedule_round_trip", "stored_days", "rt_upsert_batches", "rt_dedup_batch",
    "forecast_mae", "forecast_next_stops",
)


def test_imports_need_no_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["walking_transfers", "stop_search", "fused_max_delay", "alerts_by_route", "next_calls"])
def test_no_products(spark, name):
    text = plan(entries.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entries.queries()["departure_window"](spark, SF))
    assert "PushedFilters: [IsNotNull(arr_secs), GreaterThanOrEqual(arr_secs,52200), LessThan(arr_secs,55800)]" in text
    text = plan(entries.queries()["trip_length"](spark, SF))
    assert "ReadSchema: struct<trip_id:string,stop_sequence:int>" in text


def shape(rows, names):
    def cell(value):
        return "" if value is None else repr(round(value, 6)) if isinstance(value, float) else str(value)

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = db.execute(entries.oracle_sql()[name])
        names = [d[0] for d in result.description]
        wanted = shape(result.fetchall(), names)
    df = entries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert shape([tuple(r) for r in df.collect()], df.columns) == wanted
    assert wanted


def test_entry(spark):
    assert entries.entry(spark).agg(F.count(F.lit(1))).first()[0] == 100
