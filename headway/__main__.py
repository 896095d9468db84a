"""Jobs from the command line; see README.md."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.times import clock_secs
from headway.operators.features import delay_series
from headway.operators.fusion import fuse_max_delay
from headway.operators.schedule import static_schedule
from headway.plans.forecast import fit, forecast_next_stops, number_calls, supervised_rows
from headway.plans.journeys import journeys_by_name
from headway.plans.network import forget_network, load_network
from headway.plans.routing import MAX_ROUNDS, WINDOW_SECS
from headway.plans.timetable import preprocess
from headway.sources.gtfs import ROWS_PER_FILE, read_gtfs, stop_calls, write_csv
from headway.sources.keyed import BUCKETS
from headway.sources.workspace import Workspace
from headway.streaming.ingest import current_table, upsert_alert_feed, upsert_trip_feed

FEEDS = {"trip-updates": upsert_trip_feed, "alerts": upsert_alert_feed}


def _schedule(spark: SparkSession, folder: str) -> DataFrame:
    return static_schedule(
        read_gtfs(spark, folder, "trips"),
        stop_calls(read_gtfs(spark, folder, "stop_times")),
        read_gtfs(spark, folder, "stops"),
    )


def journeys(spark: SparkSession, args: argparse.Namespace) -> None:
    ws = Workspace(spark)
    try:
        _journeys(spark, ws, args)
    finally:
        ws.drop()


def _journeys(spark: SparkSession, ws: Workspace, args: argparse.Namespace) -> None:
    network = load_network(spark, f"{args.timetable}/network")
    request = spark.createDataFrame(
        [(1, args.day, args.time, args.origin, args.destination)],
        "request_id int, day string, time string, origin string, destination string",
    ).withColumn("departure_secs", clock_secs(F.col("time")))
    found = journeys_by_name(
        ws, network, request.drop("time"), network.stops, network.trips, max_rounds=args.rounds, window_secs=args.window,
        trace=args.trace,
    )
    write_csv(found.orderBy("origin_name", "rank", "leg_no"), args.output)
    forget_network(spark, f"{args.timetable}/network")


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    writer = FEEDS[args.feed](spark, args.landing, args.folder, args.checkpoint, buckets=args.buckets)
    writer = writer.trigger(processingTime=args.every) if args.every else writer.trigger(availableNow=True)
    writer.start().awaitTermination()


def fuse(spark: SparkSession, args: argparse.Namespace) -> None:
    updates = current_table(spark, "stops", f"{args.folder}/stops")
    fused = fuse_max_delay(_schedule(spark, args.gtfs), updates, args.route, args.direction, args.compat)
    if args.csv:
        write_csv(fused, args.output)
    else:
        fused.write.mode("overwrite").parquet(args.output)


def forecast(spark: SparkSession, args: argparse.Namespace) -> None:
    ws = Workspace(spark)
    try:
        _forecast(spark, ws, args)
    finally:
        ws.drop()


def _forecast(spark: SparkSession, ws: Workspace, args: argparse.Namespace) -> None:
    schedule, trips = _schedule(spark, args.gtfs), read_gtfs(spark, args.gtfs, "trips")
    fused = fuse_max_delay(schedule, current_table(spark, "stops", f"{args.folder}/stops"), one_row=True)
    series = delay_series(ws, fused.join(trips.select("trip_id", "direction_id"), "trip_id"))
    model = fit(ws.save(supervised_rows(ws, series), "supervised"))
    forecast_next_stops(model, series, number_calls(ws, schedule), trips, args.stops).write.mode(
        "overwrite"
    ).parquet(args.output)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="headway", description="Public-transit analytics on Spark.")
    jobs = parser.add_subparsers(required=True)

    job = jobs.add_parser("preprocess")
    job.add_argument("gtfs")
    job.add_argument("output")
    job.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    job.set_defaults(run=lambda spark, args: preprocess(spark, args.gtfs, args.output, args.rows_per_file))

    job = jobs.add_parser("journeys")
    job.add_argument("timetable", help="the folder that preprocess has filled")
    job.add_argument("day", help="a weekday, or a date as yyyyMMdd where the schedule lists exceptions")
    for name in ("time", "origin", "destination", "output"):
        job.add_argument(name)
    job.add_argument("--rounds", type=int, default=MAX_ROUNDS)
    job.add_argument("--window", type=int, default=WINDOW_SECS, help="seconds after departure that are searched")
    job.add_argument("--trace", help="a folder for the labels of each round")
    job.set_defaults(run=journeys)

    job = jobs.add_parser("ingest")
    job.add_argument("feed", choices=sorted(FEEDS), help="trip updates fill the tables trips, stops and vehicles")
    for name in ("landing", "folder", "checkpoint"):
        job.add_argument(name)
    job.add_argument("--buckets", type=int, default=BUCKETS, help="of each table, fixed when it is made")
    job.add_argument("--every", help="keep running with this interval, such as '300 seconds'")
    job.set_defaults(run=ingest)

    job = jobs.add_parser("fuse")
    for name in ("gtfs", "folder", "output"):
        job.add_argument(name)
    job.add_argument("--route")
    job.add_argument("--direction", type=int)
    job.add_argument("--compat", action="store_true")
    job.add_argument("--csv", action="store_true")
    job.set_defaults(run=fuse)

    job = jobs.add_parser("forecast")
    for name in ("gtfs", "folder", "output"):
        job.add_argument(name)
    job.add_argument("--stops", type=int, default=20)
    job.set_defaults(run=forecast)

    args = parser.parse_args(arguments)
    args.run(SparkSession.builder.appName("headway").getOrCreate(), args)


if __name__ == "__main__":
    main()
