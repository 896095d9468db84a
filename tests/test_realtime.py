import json

from conftest import rows
from pyspark.sql import functions as F
from headway.operators import merge
from headway.schemas import ALERT_FEED, REALTIME_TABLES, TRIP_FEED
from headway.sources import feeds
from headway.sources.keyed import KeyedTable
from headway.sources.workspace import list_folders
from headway.streaming.ingest import (
    current_table,
    read_feed_stream,
    suppress_duplicates,
    upsert_alert_feed,
    upsert_stream,
    upsert_trip_feed,
)

TRIP = {"trip_id": "t1", "start_date": "20221101", "route_id": "R1", "direction_id": 1}


def trip_message(at=1000, delay=30):
    return {
        "header": {"timestamp": at},
        "entity": [
            {
                "id": "e1",
                "trip_update": {
                    "timestamp": at,
                    "trip": TRIP,
                    "stop_time_update": [
                        {"stop_sequence": 1, "stop_id": "a", "arrival": {"delay": delay, "time": 5000000000},
                         "departure": {"delay": 40, "time": 5000000010}},
                        {},
                        {"stop_sequence": 2, "stop_id": "b", "departure": {"delay": 0, "time": 77}},
                    ],
                    "vehicle": {"id": "v1", "label": "L1"},
                },
            },
            {"id": "e2", "trip_update": {"trip": {**TRIP, "trip_id": "t2"}, "stop_time_update": []}},
            {"id": "e3"},
        ],
    }


CAMEL = {
    "header": {"timestamp": "1000"},
    "entity": [
        {
            "id": "e1",
            "tripUpdate": {
                "timestamp": "1000",
                "trip": {"tripId": "t1", "startDate": "20221101", "routeId": "R1", "directionId": 1},
                "stopTimeUpdate": [
                    {"stopSequence": 1, "stopId": "a", "arrival": {"delay": 30, "time": "5000000000"},
                     "departure": {"delay": 40, "time": "5000000010"}},
                    {},
                    {"stopSequence": 2, "stopId": "b", "departure": {"delay": 0, "time": "77"}},
                ],
                "vehicle": {"id": "v1", "label": "L1"},
            },
        },
        {"id": "e2", "tripUpdate": {"trip": {"tripId": "t2", "startDate": "20221101", "routeId": "R1", "directionId": 1}}},
        {"id": "e3"},
    ],
}


def put(folder, name, message):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(message, indent=1))
    return str(folder)


def test_trip_feed_in_both_spellings(spark, tmp_path):
    plain = feeds.read_trip_updates(spark, put(tmp_path / "a", "m", trip_message()))
    camel = feeds.read_trip_updates(spark, put(tmp_path / "b", "m", CAMEL), camel=True)
    assert rows(feeds.feed_stops(plain)) == [
        ("a", "t1", 1, 30, 5000000000, 40, 5000000010, 1000), ("b", "t1", 2, -1, -1, 0, 77, 1000),
    ]
    assert rows(feeds.feed_trips(plain)) == [
        ("t1", "20221101", "R1", 1, 1000), ("t2", "20221101", "R1", 1, -1),
    ]
    assert rows(feeds.feed_vehicles(plain)) == [("v1", "t1", "L1", 1000)]
    for flat in (feeds.feed_stops, feeds.feed_trips, feeds.feed_vehicles, feeds.feed_counts):
        assert rows(flat(camel)) == rows(flat(plain))
    assert rows(feeds.feed_counts(plain)) == [(-1, 1, 0, 0), (1000, 1, 2, 1)]


def test_alert_feed_in_both_spellings(spark, tmp_path):
    informed = [{"route_type": 3, "route_id": "R1"}, {"route_type": 3, "stop_id": "9"}, {"route_type": 3, "route_id": "R2", "stop_id": "9"}]
    plain = {
        "header": {"timestamp": 50},
        "entity": [
            {"id": "A1", "alert": {"active_period": [{"start": 10}, {"start": 11, "end": 12}], "cause": 10, "effect": 4,
                                   "severity_level": 3, "informed_entity": informed}},
            {"id": "A2", "alert": {"cause": 1, "effect": 1, "severity_level": 1, "informed_entity": informed[:1]}},
            {"id": "A3"},
        ],
    }
    camel_informed = [{"routeType": 3, "routeId": "R1"}, {"routeType": 3, "stopId": "9"}, {"routeType": 3, "routeId": "R2", "stopId": "9"}]
    camel = {
        "header": {"timestamp": "50"},
        "entity": [
            {"id": "A1", "alert": {"activePeriod": [{"start": "10"}, {"start": "11", "end": "12"}], "cause": "CONSTRUCTION",
                                   "effect": "DETOUR", "severityLevel": "WARNING", "informedEntity": camel_informed}},
            {"id": "A2", "alert": {"cause": "UNKNOWN_CAUSE", "effect": "NO_SERVICE", "severityLevel": "UNKNOWN_SEVERITY",
                                   "informedEntity": camel_informed[:1]}},
            {"id": "A3"},
        ],
    }
    a = rows(feeds.feed_alerts(feeds.read_alerts(spark, put(tmp_path / "a", "m", plain))))
    b = rows(feeds.feed_alerts(feeds.read_alerts(spark, put(tmp_path / "b", "m", camel), camel=True)))
    assert a == b == [
        ("A1", "R1", 10, -1, "-1", 3, 50, 10, 4, 3),
        ("A1", "R2", 10, -1, "9", 3, 50, 10, 4, 3),
        ("A2", "R1", None, -1, "-1", 3, 50, 1, 1, 1),
    ]
    text = spark.createDataFrame([(json.dumps(plain),)], "json string")
    assert rows(feeds.feed_alerts(feeds.parse_feed(text, "json", ALERT_FEED))) == a


def test_upsert_keeps_the_newest_and_replays_change_nothing(spark):
    schema, keys = REALTIME_TABLES["alerts"]
    old = spark.createDataFrame([("A1", "R1", 1, 2, "-1", 3, 10, 1, 1, 4), ("A2", "R1", 1, 2, "9", 3, 10, 1, 1, 1)], schema)
    new = spark.createDataFrame([("A1", "R1", 5, 6, "-1", 3, 20, 2, 2, 1), ("A1", "R1", 5, 6, "-1", 3, 20, 2, 1, 9)], schema)
    merged = merge.upsert_table("alerts", old, new)
    assert rows(merged) == [("A1", "R1", 5, 6, "-1", 3, 20, 2, 2, 1), ("A2", "R1", 1, 2, "9", 3, 10, 1, 1, 1)]
    assert rows(merge.upsert_table("alerts", merged, new.unionByName(old))) == rows(merged)
    assert rows(merge.key_violations(old.unionByName(new), keys)) == [("A1", "-1", "R1", 3)]
    assert merge.key_violations(merged, keys).count() == 0
    # Both have severity 1; the earlier end of the active period decides.
    assert rows(merge.bottom_k(merged, "severity_level", 1), "alert_id") == [("A2",)]


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def test_streams_equal_the_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    put(landing, "s1", trip_message(1000, 30))
    put(landing, "s2", trip_message(1300, 50))
    table, state = str(tmp_path / "stops"), str(tmp_path / "state")

    def ingest(files=1):
        flat = feeds.feed_stops(read_feed_stream(spark, str(landing), TRIP_FEED, files))
        run(upsert_stream(flat, "stops", table, state))

    ingest()
    batch = merge.latest_by_key(
        feeds.feed_stops(feeds.read_trip_updates(spark, str(landing))), REALTIME_TABLES["stops"][1]
    )
    assert rows(current_table(spark, "stops", table)) == rows(batch)
    assert current_table(spark, "stops", table).count() == 4
    # The same content again, as a later file and as a stream started from nothing.
    put(landing, "s3", trip_message(1300, 50))
    ingest()
    assert rows(current_table(spark, "stops", table)) == rows(batch)
    state = str(tmp_path / "fresh")
    ingest(files=3)
    assert rows(current_table(spark, "stops", table)) == rows(batch)


def test_stream_without_duplicates(spark, tmp_path):
    landing = tmp_path / "landing"
    for name in ("s1", "s2"):
        put(landing, name, trip_message(1000, 30))
    flat = feeds.feed_stops(read_feed_stream(spark, str(landing), TRIP_FEED, 1))
    out = suppress_duplicates(flat, "stops").writeStream.format("parquet")
    run(out.option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")))
    once = suppress_duplicates(feeds.feed_stops(feeds.read_trip_updates(spark, str(landing))), "stops")
    assert rows(spark.read.parquet(str(tmp_path / "out")), *once.columns) == rows(once)
    assert once.count() == 2


def test_a_later_batch_corrects_the_same_snapshot(spark, tmp_path):
    landing, table, state = tmp_path / "landing", str(tmp_path / "stops"), str(tmp_path / "state")

    def ingest():
        flat = feeds.feed_stops(read_feed_stream(spark, str(landing), TRIP_FEED, 1))
        run(upsert_stream(flat, "stops", table, state))

    put(landing, "s1", trip_message(1000, 100))
    ingest()
    put(landing, "s2", trip_message(1000, 10))
    ingest()
    delays = current_table(spark, "stops", table).agg(F.max("arrival_delay"), F.max("departure_delay")).first()
    assert max(delays) < 100


ROWS = "k string, snapshot_ts long, v int"


def keyed(spark, folder, buckets=4):
    return KeyedTable(spark, str(folder), ROWS, ["k"], buckets)


def changes(spark, *lines):
    return spark.createDataFrame(lines, ROWS)


def test_merges_rewrite_touched_buckets_only(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    assert table.read().count() == 0
    assert table.merge(changes(spark, *[(f"k{i}", 10, i) for i in range(40)], (None, 10, -1)), 0)
    first = table.snapshot()
    assert set(first.written_by.values()) == {1} and len(first.written_by) == 4
    assert table.merge(changes(spark, ("k7", 20, 70), ("k7", 15, 71)), 1)
    second = table.snapshot()
    assert sorted(second.written_by.values()) == [1, 1, 1, 2]
    assert rows(table.read().filter("k = 'k7'")) == [("k7", 20, 70)] and table.read().count() == 41
    # An older snapshot does not win, one of equal age that is merged later does, a null key is a key.
    table.merge(changes(spark, ("k7", 19, 1), ("k8", 10, 1), (None, 11, 5)), 2)
    assert rows(table.read().filter("k in ('k7', 'k8') or k is null")) == [("k7", 20, 70), ("k8", 10, 1), (None, 11, 5)]
    # Earlier snapshots stay readable until they are cleared away.
    assert rows(table.read(1).filter("k = 'k7'")) == [("k7", 10, 7)]
    whole = rows(table.read())
    table.vacuum(keep=1)
    assert rows(table.read()) == whole and table._merges() == [3]
    stored = list_folders(spark, f"{table.folder}/data")
    assert sorted(f"merge={m}" for m in set(table.snapshot().written_by.values())) == sorted(stored)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    assert table.merge(changes(spark, ("a", 10, 1)), 0, "x") and table.merge(changes(spark, ("a", 10, 2)), 1, "x")
    before, merges = rows(table.read()), table._merges()
    assert not table.merge(changes(spark, ("a", 10, 1)), 0, "x") and not table.merge(changes(spark, ("a", 10, 9)), 1, "x")
    assert rows(table.read()) == before == [("a", 10, 2)] and table._merges() == merges
    # Another source numbers its own batches; an empty batch is a batch.
    assert table.merge(changes(spark, ("b", 1, 1)), 0, "y") and table.merge(changes(spark, ("b", 1, 1)).filter("false"), 1, "y")
    assert table.snapshot().last_batch == {"x": 1, "y": 1} and table.read().count() == 2


def test_a_merge_that_did_not_end_is_not_seen(spark, tmp_path):
    """Data without a snapshot, and a snapshot that was not committed, as after a crash."""
    table = keyed(spark, tmp_path / "t")
    table.merge(changes(spark, ("a", 10, 1)), 0)
    changes(spark, ("a", 99, 9)).write.parquet(f"{table.folder}/data/merge=2/bucket=0")
    (tmp_path / "t" / "snapshots" / "merge=2").mkdir()
    assert rows(table.read()) == [("a", 10, 1)]
    assert table.merge(changes(spark, ("a", 11, 2)), 1) and rows(table.read()) == [("a", 11, 2)]


def test_one_pass_fills_three_tables_from_both_spellings(spark, tmp_path):
    """A stream of mixed files, stopped after two and started again; each file is read once."""
    landing, folder, state = tmp_path / "landing", str(tmp_path / "tables"), str(tmp_path / "state")
    put(landing, "s1", CAMEL)
    put(landing, "s2", trip_message(1300, 50))
    read = []

    def ingest():
        query = upsert_trip_feed(spark, str(landing), folder, state, files_per_batch=1, buckets=2).trigger(availableNow=True).start()
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))

    ingest()
    plain = put(tmp_path / "plain", "s1", trip_message(1000, 30))
    put(tmp_path / "plain", "s2", trip_message(1300, 50))
    messages = feeds.read_trip_updates(spark, plain)
    wanted = {"trips": feeds.feed_trips, "stops": feeds.feed_stops, "vehicles": feeds.feed_vehicles}
    for table, flatten in wanted.items():
        batch = merge.latest_by_key(flatten(messages), REALTIME_TABLES[table][1])
        assert rows(current_table(spark, table, f"{folder}/{table}")) == rows(batch) and batch.count() > 0
    put(landing, "s3", trip_message(1300, 10))
    ingest()
    assert read == [2, 1]
    assert max(r.arrival_delay for r in current_table(spark, "stops", f"{folder}/stops").filter("snapshot_ts = 1300").collect()) == 10
    assert list_folders(spark, f"{folder}/_messages") == []


def test_alerts_in_both_spellings(spark, tmp_path):
    landing, folder = tmp_path / "landing", str(tmp_path / "tables")
    informed = [{"route_type": 3, "route_id": "R1"}]
    put(landing, "s1", {"header": {"timestamp": 50}, "entity": [{"id": "A1", "alert": {"cause": 10, "effect": 4, "severity_level": 3, "informed_entity": informed}}]})
    put(landing, "s2", {"header": {"timestamp": "60"}, "entity": [{"id": "A2", "alert": {"cause": "CONSTRUCTION", "effect": "DETOUR", "severityLevel": "WARNING", "informedEntity": [{"routeType": 3, "routeId": "R1"}]}}]})
    run(upsert_alert_feed(spark, str(landing), folder, str(tmp_path / "state")))
    found = current_table(spark, "alerts", f"{folder}/alerts")
    assert rows(found, "alert_id", "route_id", "snapshot_ts", "cause", "effect", "severity_level") == [("A1", "R1", 50, 10, 4, 3), ("A2", "R1", 60, 10, 4, 3)]
