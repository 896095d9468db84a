"""The network that journeys are searched on, laid out once and stored for later searches.

Stops, trips and services are dense numbers in the order of their ids, so rows have fixed width.
Calls are stored twice, bucketed and sorted by the keys of the two joins of a round: by stop and
time slot for boarding, by trip for the ride. A search shuffles its own rows to the buckets and
never the calls. Both copies are also partitioned by bands of the day, so only those a search can
use are read.

A stored network is a folder of versions. A version is complete once its manifest is written, and
readers take the newest one, so a new timetable can be published while searches run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.geo import WALKING_SPEED_MPS
from headway.operators.skew import ROWS_PER_TASK, count_keys, number_rows, spread
from headway.sources.workspace import Workspace, list_folders, path_exists, short_shuffles

# Width of the slots of the day that calls are joined by, and slots of a band they are stored by.
SLOT_SECS = 900
BAND_SLOTS = 12

# Calls of a bucket.
ROWS_PER_BUCKET = 100_000

# A choice inside the rounds is one whole number: seconds in the high bits (up to three days), then
# two bits of mode where there is one, then the trip or stop number.
NUMBER_BITS = 43
TRIP_BITS = NUMBER_BITS + 2

# The high bits less an hour, which a walk at the end may take.
_SECS_LIMIT = (1 << (63 - TRIP_BITS)) - 3600

STOP_KEY = ["stop_no", "slot", "stop_salt"]
TRIP_KEY = ["trip_no", "trip_salt"]

# Services whose days fit one whole number.
_WORD = 64


@dataclass(frozen=True)
class Network:
    """``hot_stops`` and ``hot_trips`` hold the fanout of the keys whose calls are too many for one
    task; ``most_calls`` is what is left of the largest key; ``buckets`` is how many the calls lie in. ``days`` gives the services of a weekday
    or date as bits. Staying at a stop is a move of no length."""

    calls_by_stop: DataFrame
    calls_by_trip: DataFrame
    hot_stops: DataFrame
    hot_trips: DataFrame
    days: DataFrame
    stops: DataFrame
    trips: DataFrame
    moves: DataFrame
    most_calls: int
    buckets: int


def slot_of(secs: Column | str) -> Column:
    secs = F.col(secs) if isinstance(secs, str) else secs
    return F.floor(secs / SLOT_SECS).cast("int")


def _band(slot: Column) -> Column:
    return F.floor(slot / BAND_SLOTS).cast("int")


def check_secs(first: int | None, last: int | None) -> None:
    """Times that a packed choice can't hold would win or lose wrongly, so they are refused."""
    if first is not None and (first < 0 or last >= _SECS_LIMIT):
        raise ValueError(f"times of the day must lie in 0 to {_SECS_LIMIT} seconds, not {first} to {last}")


def walk_secs(metres: Column) -> Column:
    """Whole seconds, rounded up, so that equal arrivals tie in every engine."""
    return F.ceil(metres / WALKING_SPEED_MPS).cast("int")


def running_services(services: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(day, running)``: the numbers of the services of each day as bits, by words of 64."""
    number = F.col("service_no") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % _WORD).cast("int"))
    words = services.join(numbers, "service_id").groupBy("day", F.floor(number / _WORD).cast("int").alias("word"))
    return words.agg(F.bit_or(bit).alias("bits")).groupBy("day").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("running")
    )


def runs_on(service_no: str = "service_no", running: str = "running") -> Column:
    """Whether a service is among those of a day."""
    return F.expr(
        f"shiftright(coalesce(element_at({running}, CAST(({service_no} - 1) DIV {_WORD} AS INT)), 0L), "
        f"CAST(({service_no} - 1) % {_WORD} AS INT)) & 1L = 1L"
    )


def publish_network(
    ws: Workspace,
    folder: str,
    calls: DataFrame,
    services: DataFrame,
    stops: DataFrame,
    transfers: DataFrame,
    trips: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Network:
    """Lay out ``calls`` and ``stops``, stored tables as ``build_timetable`` gives them, as a new version.

    ``services`` are ``(day, service_id)``, where a day is a weekday or a date as ``yyyyMMdd``. ``stops``
    has a row per stop and ``trips`` one per trip, which saves a pass over the calls; their further
    columns are kept for naming results. What ``ws`` gets along the way may go afterwards.
    """
    with short_shuffles(ws.spark):
        _write_version(ws, folder, calls, services, stops, transfers, trips, rows_per_task, rows_per_bucket)
    return load_network(ws.spark, folder)


def _write_version(
    ws: Workspace, folder: str, calls: DataFrame, services: DataFrame, stops: DataFrame, transfers: DataFrame,
    trips: DataFrame | None, rows_per_task: int, rows_per_bucket: int,
) -> None:
    version = f"{folder}/versions/{uuid.uuid4().hex}"
    trips = calls.select("trip_id").distinct() if trips is None else trips
    services_run = calls.select("service_id").distinct()
    for name, rows, id_column, number in (
        ("trips", trips, "trip_id", "trip_no"), ("stops", stops, "stop_id", "stop_no"), ("services", services_run, "service_id", "service_no")
    ):
        number_rows(ws, rows, [], [id_column], number, rows_per_task).write.parquet(f"{version}/{name}")
    trip_ids, stop_ids, service_ids = (ws.spark.read.parquet(f"{version}/{name}") for name in ("trips", "stops", "services"))
    running_services(services, service_ids).write.parquet(f"{version}/days")

    span = calls.agg(
        F.min(F.least("arr_secs", "dep_secs")).alias("first"), F.max(F.greatest("arr_secs", "dep_secs")).alias("last"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    check_secs(span["first"], span["last"])
    numbered = ws.save(
        calls.join(trip_ids.select("trip_id", "trip_no"), "trip_id")
        .join(stop_ids.select("stop_id", "stop_no"), "stop_id")
        .join(service_ids, "service_id")
        .select("trip_no", "stop_no", "service_no", "stop_sequence", "arr_secs", "dep_secs", "pattern"),
        "numbered_calls",
    )
    # A call is listed in the slot it arrives in and in those it stands at the stop in, so a long
    # stay concerns its own call only. One that leaves before it arrives has the slot it leaves in.
    arrives = F.least(slot_of("arr_secs"), slot_of("dep_secs"))
    slotted = numbered.withColumn("slot", F.explode(F.sequence(arrives, slot_of("dep_secs"))))
    buckets = max(1, -(-span["rows"] // rows_per_bucket))
    most = 0
    for name, keys, spread_by, df in (
        ("stop", ["stop_no", "slot"], ["trip_no", "stop_sequence"], slotted.withColumn("band", _band(F.col("slot")))),
        ("trip", ["trip_no"], ["stop_sequence", "stop_no"],
         numbered.select("trip_no", "stop_no", "stop_sequence", "arr_secs", _band(slot_of("arr_secs")).alias("band"))),
    ):
        rows = ws.save(count_keys(df, keys, "calls"), f"{name}_calls")
        largest = rows.agg(F.max("calls")).first()[0] or 0
        most = max(most, min(largest, rows_per_task))
        fanout = F.ceil(F.col("calls") / rows_per_task).cast("int").alias("fanout")
        rows.filter(F.col("calls") > rows_per_task).select(*keys, fanout).write.parquet(f"{version}/hot_{name}s")
        hot = ws.spark.read.parquet(f"{version}/hot_{name}s")
        key = [*keys, f"{name}_salt"]
        salted = spread(df, keys, hot, spread_by, f"{name}_salt")
        _write_buckets(salted, f"{version}/calls_by_{name}", key, buckets)

    staying = stop_ids.select(F.col("stop_no").alias("from_no"), F.col("stop_no").alias("to_no"), F.lit(0).alias("walk_secs"))
    starts = stop_ids.select(F.col("stop_id").alias("from_stop_id"), F.col("stop_no").alias("from_no"))
    ends = stop_ids.select(F.col("stop_id").alias("to_stop_id"), F.col("stop_no").alias("to_no"))
    walks = transfers.join(starts, "from_stop_id").join(ends, "to_stop_id")
    walks = walks.select("from_no", "to_no", walk_secs(F.col("distance")).alias("walk_secs"))
    staying.unionByName(walks).write.parquet(f"{version}/moves")
    manifest = ws.spark.range(1).select(
        F.lit(version.rsplit("/", 1)[1]).alias("version"), F.current_timestamp().alias("published"),
        F.lit(buckets).alias("buckets"), F.lit(most).alias("most_calls"),
    )
    manifest.coalesce(1).write.mode("append").parquet(f"{folder}/manifests")


def _table_name(path: str) -> str:
    return "headway_" + "_".join(path.rsplit("/", 2)[1:])


def _write_buckets(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Each task writes one bucket, so there is one file per bucket and band."""
    (
        df.repartition(buckets, *keys)
        .write.partitionBy("band")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("compression", "zstd")
        .option("path", path)
        .saveAsTable(_table_name(path))
    )


def _read_buckets(spark: SparkSession, path: str, keys: list[str], buckets: int) -> DataFrame:
    """The bucketed table at a path, made known to this session's catalogue where it is not."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        fields = spark.read.parquet(path).schema.fields
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (band) "
            f"CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def forget_network(spark: SparkSession, folder: str) -> None:
    """Take the tables of a stored network out of the session's catalogue; the files stay.

    Networks loaded before must not be used any more.
    """
    for version in list_folders(spark, f"{folder}/versions"):
        for name in ("calls_by_stop", "calls_by_trip"):
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{folder}/versions/{version}/{name}')}")


def load_network(spark: SparkSession, folder: str) -> Network:
    """The newest complete version of a stored network; nothing is computed."""
    if not path_exists(spark, f"{folder}/manifests"):
        raise FileNotFoundError(f"no network is stored in {folder}")
    newest = spark.read.parquet(f"{folder}/manifests").orderBy(F.desc("published"), "version").first()
    version = f"{folder}/versions/{newest['version']}"
    read = {name: spark.read.parquet(f"{version}/{name}") for name in ("hot_stops", "hot_trips", "days", "stops", "trips", "moves")}
    return Network(
        calls_by_stop=_read_buckets(spark, f"{version}/calls_by_stop", STOP_KEY, newest["buckets"]),
        calls_by_trip=_read_buckets(spark, f"{version}/calls_by_trip", TRIP_KEY, newest["buckets"]),
        most_calls=newest["most_calls"],
        buckets=newest["buckets"],
        **read,
    )


def prepare_network(
    ws: Workspace, calls: DataFrame, services: DataFrame, stops: DataFrame, transfers: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> Network:
    """A network for one job, stored in its workspace."""
    return publish_network(ws, f"{ws.folder}/network-{uuid.uuid4().hex}", calls, services, stops, transfers, rows_per_task=rows_per_task)


def usable_calls(network: Network, first_secs: int, end_secs: int) -> tuple[DataFrame, DataFrame]:
    """The calls by stop and by trip that arrive in ``[first, end)`` or leave after ``first``; other bands
    of the day are not read."""
    low, high = first_secs // SLOT_SECS // BAND_SLOTS, (end_secs - 1) // SLOT_SECS // BAND_SLOTS
    bands = F.col("band").between(low, high)
    arrives = (F.col("arr_secs") >= first_secs) & (F.col("arr_secs") < end_secs)
    by_stop = network.calls_by_stop.filter(bands & (F.col("arr_secs") < end_secs)).drop("band")
    return by_stop, network.calls_by_trip.filter(bands & arrives).drop("band")
