from datetime import date

from pyspark.sql import functions as F

from conftest import adaptive, rows
from headway.functions.geo import haversine_m
from headway.functions.times import clock_secs, clock_text, epoch_day, service_date
from headway.operators import schedule
from headway.operators.transfers import walking_transfers
from headway.plans.timetable import preprocess
from headway.schemas import GTFS_FILES
from headway.sources.gtfs import deal_days, read_day, read_gtfs, stop_calls, write_csv, write_days
from headway.sources.workspace import Workspace


def calendar(spark, *lines):
    return spark.createDataFrame(lines, GTFS_FILES["calendar"])


def calls(spark, *lines):
    """(trip, stop, sequence, arrival, departure) in seconds."""
    return spark.createDataFrame(
        lines, "trip_id string, stop_id string, stop_sequence int, arr_secs int, dep_secs int"
    )


def trips(spark, *lines):
    return spark.createDataFrame(lines, "trip_id string, route_id string, service_id string, direction_id int")


def test_clock(spark):
    df = spark.createDataFrame([("25:30:01",), (" 5:30:00",), ("14:30",), ("x",), (None,)], "t string")
    secs = [r[0] for r in df.select(clock_secs(F.col("t"))).collect()]
    assert secs == [91801, 19800, 52200, None, None]
    text = spark.range(1).select(clock_text(F.lit(91801)), epoch_day(F.lit(-1).cast("long"))).first()
    assert tuple(text) == ("25:30:01", date(1969, 12, 31))
    assert spark.range(1).select(service_date(F.lit(20220905)), service_date(F.lit("nope"))).first()[:] == (
        date(2022, 9, 5), None,
    )


def test_services(spark):
    weekdays = calendar(
        spark,
        ("1", 1, 1, 1, 1, 1, 0, 0, "20220905", "20220918"),
        ("2", 0, 0, 0, 0, 0, 1, 0, "20220905", "20220918"),
        ("idle", 0, 0, 0, 0, 0, 0, 0, "20220905", "20220918"),
    )
    by_day = rows(schedule.services_by_day(weekdays))
    assert ("saturday", "2") in by_day and ("monday", "1") in by_day and len(by_day) == 6
    changes = spark.createDataFrame(
        [("1", "20220905", 2), ("2", "20220905", 1), ("idle", "20221225", 1)], GTFS_FILES["calendar_dates"]
    )
    by_date = rows(schedule.services_by_date(weekdays, changes))
    assert (date(2022, 9, 5), "1") not in by_date
    assert (date(2022, 9, 5), "2") in by_date
    assert (date(2022, 12, 25), "idle") in by_date
    assert len(by_date) == 10 + 2 - 1 + 2
    assert schedule.calendar_days(weekdays).count() == 14


def test_late_calls_and_window_edges(spark):
    df = calls(spark, ("t", "a", 1, 86399, 86400), ("t", "b", 2, 86400, 86410))
    assert rows(schedule.same_day_calls(df), "stop_id") == [("a",)]
    edge = calls(spark, ("t", "a", 1, 50400, 0), ("t", "b", 2, 53999, 0), ("t", "c", 3, 54000, 0), ("t", "d", 4, 50399, 0))
    assert rows(schedule.departure_window(edge, 50400), "stop_id") == [("a",), ("b",)]


def test_patterns_tell_sequences_and_stops_apart(spark):
    df = calls(
        spark,
        ("p", "x", 1, 0, 0), ("p", "y", 12, 0, 0),
        ("q", "x", 11, 0, 0), ("q", "y", 2, 0, 0),
        ("r", "x", 1, 9, 9), ("r", "y", 12, 9, 9),
        ("s", "y", 1, 0, 0), ("s", "x", 12, 0, 0),
        ("u", "x", 1, 0, 0), ("u", "y", 12, 0, 0),
    )
    t = trips(spark, *[(i, "R2" if i == "u" else "R1", "1", 0) for i in "pqrsu"])
    pattern = dict(rows(schedule.trip_patterns(df, t), "trip_id", "pattern"))
    assert pattern["p"] == pattern["r"]
    assert len({pattern[i] for i in "pqsu"}) == 4
    assert pattern["u"].startswith("R2--")


def located(spark, *lines):
    return spark.createDataFrame(lines, "stop_id string, stop_lat double, stop_lon double")


def brute(stops, metres):
    a = stops.toDF("f", "fy", "fx")
    b = stops.toDF("t", "ty", "tx")
    gap = haversine_m(F.col("fy"), F.col("fx"), F.col("ty"), F.col("tx"))
    return a.crossJoin(b).filter((F.col("f") != F.col("t")) & (gap < metres)).select("f", "t")


def test_walk_limit_and_speed(spark, ws):
    step = 90 / 111226.0
    got = walking_transfers(ws, located(spark, ("a", 49.0, -123.0), ("b", 49.0 + step, -123.0), ("c", 49.0 - 101 / 111226.0, -123.0)))
    found = {(r.from_stop_id, r.to_stop_id): r for r in got.collect()}
    assert set(found) == {("a", "b"), ("b", "a")}
    walk = found["a", "b"]
    assert abs(walk.distance - 90) < 0.1 and abs(walk.transfer_time - walk.distance / 1.4) < 1e-9


def test_grid_equals_the_product(spark, ws):
    """Cell borders and corners, the equator, the date line, high latitudes, crowded cells."""
    lines = []
    for lat, lon in [(49.2, -123.1), (0.0, 0.0), (-33.9, 179.9999), (78.2, 15.6), (-0.0004, -180.0), (88.5, 10.0)]:
        for i in range(6):
            for j in range(6):
                x = lon + j * 0.0007 / max(0.02, 1 - abs(lat) / 90)
                lines.append((f"{lat}/{lon}/{i}/{j}", lat + i * 0.0004, (x + 180) % 360 - 180))
    stops = located(spark, *lines, ("nowhere", None, None))
    wanted = rows(brute(stops, 100.0))
    assert len(wanted) > 100
    assert rows(walking_transfers(ws, stops), "from_stop_id", "to_stop_id") == wanted
    assert rows(walking_transfers(ws, stops, rows_per_task=2), "from_stop_id", "to_stop_id") == wanted


def test_a_dense_cell_is_cut_by_its_pairs(spark):
    """Under adaptive execution no task makes more pairs than it should, and the rows are the same."""
    session = adaptive(spark)
    ws = Workspace(session)
    try:
        stops = located(session, *[(f"s{i}", 49.2 + i % 20 * 1e-6, -123.1 + i // 20 * 1e-6) for i in range(300)], ("far", 50.0, -123.1))
        plain = walking_transfers(ws, stops)
        cut = walking_transfers(ws, stops, pairs_per_task=5_000)
        assert rows(cut, "from_stop_id", "to_stop_id") == rows(plain, "from_stop_id", "to_stop_id") and plain.count() == 300 * 299
        pairs = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
        # Several blocks may meet in one task; plain, all pairs do.
        assert max(pairs) <= 4 * 5_000 and len(pairs) >= 10
        assert max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()) == 300 * 299
    finally:
        ws.drop()


def test_files_to_day_folders(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "calendar.txt").write_text(
        "﻿service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
        "1,1,1,1,1,1,0,0,20220905,20230101\n2,0,0,0,0,0,1,0,20220905,20230101\n"
    )
    head = "route_id,service_id,trip_id,trip_headsign,trip_short_name,direction_id,block_id,shape_id,wheelchair_accessible,bikes_allowed\n"
    (source / "trips.txt").write_text(head + 'R,1,t1,"Park, North",,0,,,1,1\nR,2,t2,Park,,1,,,1,1\n')
    head = "trip_id,arrival_time,departure_time,stop_id,stop_sequence,stop_headsign,pickup_type,drop_off_type,shape_dist_traveled\n"
    (source / "stop_times.txt").write_text(
        head + "t1, 5:00:00, 5:01:00,a,1,,0,0,\nt1,24:10:00,24:10:00,b,2,,0,0,1.5\nt2,6:00:00,6:00:00,a,1,,0,0,\n"
    )
    head = "stop_id,stop_code,stop_name,stop_desc,stop_lat,stop_lon,zone_id,stop_url,location_type,parent_station\n"
    (source / "stops.txt").write_text(head + 'a,1,"Main, east",,49.0,-123.0,,,0,\nb,2,Oak,,49.0005,-123.0,,,0,\n')

    assert rows(read_gtfs(spark, str(source), "trips"), "trip_id", "trip_headsign") == [("t1", "Park, North"), ("t2", "Park")]
    assert rows(stop_calls(read_gtfs(spark, str(source), "stop_times")), "arr_secs") == [(18000,), (21600,), (87000,)]
    preprocess(spark, str(source), target)
    monday = read_day(spark, f"{target}/stop_times", "monday")
    assert rows(monday, "trip_id", "stop_id", "arr_secs", "dep_secs") == [("t1", "a", 18000, 18060)]
    assert "PartitionFilters: [isnotnull(day" in monday._jdf.queryExecution().toString()
    assert rows(read_day(spark, f"{target}/stops", "saturday"), "stop_id", "stop_name") == [("a", "Main, east")]
    assert read_day(spark, f"{target}/stops", "sunday").count() == 0

    write_csv(monday.withColumn("list", F.array("stop_id")), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert rows(back, "trip_id", "list") == [("t1", '["a"]')]


def test_rows_are_sent_once_for_all_days_of_their_service(spark, tmp_path):
    """The shuffle comes before the rows are multiplied by the days; the files hold what they held."""
    spark = adaptive(spark)
    services = spark.createDataFrame([("monday", "1"), ("tuesday", "1"), ("tuesday", "2"), (None, "3")], "day string, service_id string")
    served = spark.createDataFrame([(f"t{i}", str(i % 4), i) for i in range(40)] + [("t1", "1", 1), (None, "2", 7), ("x", None, 8)],
                                   "trip_id string, service_id string, n int")
    by_day = served.join(services, "service_id").drop("service_id")
    plan = deal_days(served, "trip_id", services)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("RebalancePartitions"), plan
    write_days(served, str(tmp_path / "once"), "trip_id", services=services)
    write_days(by_day, str(tmp_path / "plain"), "trip_id")
    kept = rows(spark.read.parquet(str(tmp_path / "once")), "day", "trip_id", "n")
    assert kept == rows(spark.read.parquet(str(tmp_path / "plain")), "day", "trip_id", "n") == rows(by_day, "day", "trip_id", "n")
