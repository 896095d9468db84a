"""The command-line jobs end to end on small files."""

import json

from conftest import rows
from headway.__main__ import main

DAY = 19_000 * 86_400


def gtfs(folder):
    folder.mkdir()
    trips, times = [], []
    for i in range(40):
        trips.append(f"R,1,t{i},To Oak,,0,,,1,1")
        for n, stop in enumerate("ab", 1):
            at = 50_460 + 60 * i + 600 * (n - 1)
            text = f"{at // 3600}:{at // 60 % 60:02d}:{at % 60:02d}"
            times.append(f"t{i},{text},{text},{stop},{n},,0,0,")
    (folder / "calendar.txt").write_text(
        "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n1,1,0,0,0,0,0,0,20220101,20221231\n"
    )
    (folder / "trips.txt").write_text(
        "route_id,service_id,trip_id,trip_headsign,trip_short_name,direction_id,block_id,shape_id,wheelchair_accessible,bikes_allowed\n"
        + "\n".join(trips) + "\n"
    )
    (folder / "stop_times.txt").write_text(
        "trip_id,arrival_time,departure_time,stop_id,stop_sequence,stop_headsign,pickup_type,drop_off_type,shape_dist_traveled\n"
        + "\n".join(times) + "\n"
    )
    (folder / "stops.txt").write_text(
        "stop_id,stop_code,stop_name,stop_desc,stop_lat,stop_lon,zone_id,stop_url,location_type,parent_station\n"
        "a,,Main Station,,49.0,-123.0,,,0,\nb,,Oak Station,,49.1,-123.0,,,0,\nc,,Oak Station West,,49.1005,-123.0,,,0,\n"
        "d,,Elm,,49.5,-123.0,,,0,\n"
    )
    return str(folder)


def landing(folder):
    folder.mkdir()
    entities = []
    for i in range(40):
        updates = []
        for n, stop in enumerate("ab", 1):
            at, delay = 50_460 + 60 * i + 600 * (n - 1), 10 * (i % 7)
            event = {"delay": delay, "time": DAY + at + delay}
            updates.append({"stop_sequence": n, "stop_id": stop, "arrival": event, "departure": event})
        trip = {"trip_id": f"t{i}", "start_date": "20220108", "route_id": "R", "direction_id": 0}
        entities.append({"id": str(i), "trip_update": {"timestamp": DAY, "trip": trip, "stop_time_update": updates}})
    (folder / "s1.json").write_text(json.dumps({"header": {"timestamp": DAY}, "entity": entities}))
    return str(folder)


def test_journeys_by_name(spark, tmp_path):
    """From the stored network alone: the schedule files are gone when journeys are searched."""
    out, schedule, timetable = str(tmp_path / "found"), gtfs(tmp_path / "gtfs"), str(tmp_path / "timetable")
    main(["preprocess", schedule, timetable])
    (tmp_path / "gtfs").rename(tmp_path / "elsewhere")
    main(["journeys", timetable, "monday", "14:00", "main", "OAK station", out, "--trace", str(tmp_path / "trace")])
    found = spark.read.option("header", True).csv(out)
    columns = ["rank", "destination", "minutes", "rides", "leg_no", "method", "from_name", "to_name"]
    # The stop across the road is not served, so nothing walks there.
    assert rows(found, *columns)[0] == ("1", "b", "11", "1", "1", "To Oak", "Main Station", "Oak Station")
    assert found.filter("method = 'Walk'").count() == 0
    assert rows(spark.read.parquet(str(tmp_path / "trace")).select("round").distinct()) == [(0,), (1,)]


def test_journeys_on_a_date(spark, tmp_path):
    """An exception takes the service out on one Monday and puts it in on a Tuesday."""
    schedule, timetable = gtfs(tmp_path / "gtfs"), str(tmp_path / "timetable")
    (tmp_path / "gtfs" / "calendar_dates.txt").write_text("service_id,date,exception_type\n1,20220110,2\n1,20220111,1\n")
    main(["preprocess", schedule, timetable])
    found = {}
    for day in ("20220110", "20220111"):
        out = str(tmp_path / day)
        main(["journeys", timetable, day, "14:00", "main", "oak station", out])
        found[day] = spark.read.option("header", True).schema("x string").csv(out).count()
    assert found["20220111"] > 0 == found["20220110"]


def test_ingest_fuse_forecast(spark, tmp_path):
    schedule, table, out = gtfs(tmp_path / "gtfs"), str(tmp_path / "tables"), str(tmp_path / "out")
    main(["ingest", "trip-updates", landing(tmp_path / "landing"), table, str(tmp_path / "state"), "--buckets", "2"])
    main(["fuse", schedule, table, out, "--route", "R", "--direction", "0"])
    fused = spark.read.parquet(out)
    assert fused.count() == 80 and rows(fused.filter("trip_id = 't3' and stop_id = 'b'"), "arrival_delay") == [(30,)]
    main(["fuse", schedule, table, out + "-csv", "--csv", "--compat"])
    assert spark.read.option("header", True).csv(out + "-csv").count() == 80
    main(["forecast", schedule, table, out + "-forecast", "--stops", "4"])
    ahead = spark.read.parquet(out + "-forecast")
    # Calls follow the order of trip numbers; after the last call of t39 comes t0 again.
    assert rows(ahead, "step", "stop_name", "trip_name") == [
        (1, "Main Station", "To Oak"), (2, "Oak Station", "To Oak"), (3, "Main Station", "To Oak"), (4, "Oak Station", "To Oak"),
    ]
    assert rows(ahead.filter("step = 1"), "scheduled_time") == [("2022-01-09 14:01:00",)]
