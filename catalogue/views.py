"""Transit tables derived from the given test tables.

``calls`` and the network of journeys are needed by most queries, so they are stored once per
session and folder, as the timetable job does with its own. Everything else stays lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.operators.schedule import services_by_date
from headway.operators.skew import ROWS_PER_TASK, count_keys
from headway.plans.network import Network, load_network, publish_network
from headway.plans.timetable import Timetable, build_timetable
from headway.schemas import MISSING, WEEKDAYS
from headway.sources.workspace import Workspace, shared_folder

# Supplier keys ranked together; keys are distinct within an order and line.
_BLOCK = 4096

# Service of an order by the weekday of its date: Monday to Friday, Saturday, Sunday.
_SERVICE_DAYS = {"1": WEEKDAYS[:5], "2": WEEKDAYS[5:6], "3": WEEKDAYS[6:]}

_stored: dict[tuple[str, str], Workspace] = {}


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _days(name: str) -> Column:
    return F.datediff(F.col(name).cast("date"), F.lit("1970-01-01").cast("date"))


def _arrival(order: str) -> Column:
    """When a trip comes to the call numbered ``stop_sequence``."""
    return (18000 + (F.col(order) * 97) % 70200 + 300 * (F.col("stop_sequence") - 1)).cast("int")


def _epoch(name: str) -> Column:
    """Epoch seconds of a timestamp without time zone, whatever the session's zone is."""
    clock = F.hour(name) * 3600 + F.minute(name) * 60 + F.second(name)
    return _days(name).cast("long") * 86400 + clock


class Views:
    def __init__(self, spark: SparkSession, folder: str, rows_per_task: int = ROWS_PER_TASK) -> None:
        self.spark = spark
        self.folder = folder
        self.rows_per_task = rows_per_task
        self.ws = Workspace(spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def trips(self) -> DataFrame:
        weekday = (_days("o_orderdate") + 4) % 7
        service = F.when(weekday.between(1, 5), "1").when(weekday == 6, "2").otherwise("3")
        return self.table("orders").select(
            _text("o_orderkey").alias("trip_id"),
            F.concat(F.lit("R"), (F.col("o_custkey") % 40).cast("string")).alias("route_id"),
            service.alias("service_id"),
            (F.col("o_orderkey") % 2).cast("int").alias("direction_id"),
            F.concat(F.lit("To "), "o_orderpriority").alias("trip_headsign"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        flags = [
            F.when(
                F.col("service_id").isin(*[s for s, days in _SERVICE_DAYS.items() if day in days]), 1
            ).otherwise(0).alias(day)
            for day in WEEKDAYS
        ]
        return (
            self.trips.groupBy("service_id")
            .agg(F.min("start_date").alias("start_date"), F.max("start_date").alias("end_date"))
            .select("service_id", *flags, "start_date", "end_date")
        )

    @cached_property
    def calendar_dates(self) -> DataFrame:
        """On every fifth count of trips a day loses its service or gains the next one."""
        counted = self.trips.groupBy("service_id", "start_date").agg(F.count(F.lit(1)).alias("n"))
        kind = (F.col("n") % 2 + 1).cast("int")
        other = (F.col("service_id").cast("int") % 3 + 1).cast("string")
        return counted.filter("n % 5 = 0").select(
            F.when(kind == 1, other).otherwise(F.col("service_id")).alias("service_id"),
            F.col("start_date").alias("date"),
            kind.alias("exception_type"),
        )

    @cached_property
    def _long_orders(self) -> DataFrame | None:
        """``trip_id`` of the orders with too many lines for one task; None where there is none."""

        def find(ws: Workspace) -> None:
            lines = count_keys(self.table("lineitem"), ["l_orderkey"], "lines").filter(F.col("lines") > self.rows_per_task)
            ws.save(lines.select(_text("l_orderkey").alias("trip_id")), "long_orders")

        orders = self.spark.read.schema("trip_id string").parquet(f"{self._stored_once('long_orders', find)}/001-long_orders")
        return None if orders.isEmpty() else orders

    def _by_order(self, lines: DataFrame, whole: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``whole`` of lines that lie in one task per order, and ``cut`` of those of the long orders."""
        if self._long_orders is None:
            return whole(lines.repartition("trip_id"))
        others = lines.join(self._long_orders, "trip_id", "left_anti")
        return whole(others.repartition("trip_id")).unionByName(cut(lines.join(self._long_orders, "trip_id", "left_semi")))

    def _derive_calls(self) -> DataFrame:
        """One call per order and supplier, numbered by (least line, supplier).

        An order's lines are sent to one task, which numbers its calls. A long order's calls are
        numbered in blocks, so an order may be of any size.
        """
        lines = self.table("lineitem").filter("l_orderkey is not null").select(
            _text("l_orderkey").alias("trip_id"), "l_orderkey", "l_suppkey", "l_linenumber"
        )
        visits = ["trip_id", "l_orderkey", "l_suppkey"]

        def whole(lines: DataFrame) -> DataFrame:
            order = Window.partitionBy("trip_id").orderBy("line", "l_suppkey")
            seen = lines.groupBy(*visits).agg(F.min("l_linenumber").alias("line"))
            return seen.withColumn("stop_sequence", F.row_number().over(order))

        def cut(lines: DataFrame) -> DataFrame:
            return self._number_in_blocks(lines.groupBy(*visits).agg(F.min("l_linenumber").alias("line")))

        numbered = self._by_order(lines, whole, cut).filter("l_suppkey is not null and line is not null")
        return numbered.withColumn("arr_secs", _arrival("l_orderkey")).select(
            "trip_id",
            _text("l_suppkey").alias("stop_id"),
            "stop_sequence",
            "arr_secs",
            (F.col("arr_secs") + 30).alias("dep_secs"),
        )

    @staticmethod
    def _number_in_blocks(visits: DataFrame) -> DataFrame:
        """The number is the rank inside a block of at most ``_BLOCK`` suppliers of one line plus the
        sizes of the blocks before it."""
        visits = visits.withColumn("block", F.floor(F.col("l_suppkey") / _BLOCK))
        block = ["trip_id", "line", "block"]
        earlier = Window.partitionBy("trip_id").orderBy("line", "block").rowsBetween(Window.unboundedPreceding, -1)
        shifts = (
            visits.groupBy(*block)
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .drop("n")
        )
        inside = Window.partitionBy(*block).orderBy("l_suppkey")
        sequence = (F.row_number().over(inside) + F.col("shift")).cast("int")
        return visits.join(shifts, block).withColumn("stop_sequence", sequence).drop("block", "shift")

    def _stored_once(self, name: str, store: Callable[[Workspace], None]) -> str:
        """The folder of a workspace that ``store`` has filled, in this session or just now."""
        place = f"{shared_folder(self.spark)}:{self.folder}:{name}:{self.rows_per_task}"
        key = (self.spark.sparkContext.applicationId, place)
        if key not in _stored or not _stored[key].exists():
            ws = Workspace(self.spark)
            store(ws)
            _stored[key] = ws
        return _stored[key].folder

    @cached_property
    def calls(self) -> DataFrame:
        folder = self._stored_once("calls", lambda ws: ws.save(self._derive_calls(), "stop_times"))
        return self.spark.read.parquet(f"{folder}/001-stop_times")

    @property
    def calls_by_order(self) -> DataFrame:
        """``calls`` dealt by order, as ``rt_stops`` are, so that both meet without being dealt again."""
        return self.calls if self._long_orders is not None else self.calls.repartition("trip_id")

    @cached_property
    def timetable(self) -> Timetable:
        return build_timetable(self.ws, self.calendar, self.trips, self.calls, self.stops)

    def _publish_network(self, ws: Workspace) -> None:
        """Services are given for weekdays and for dates; trips and stops keep what names results.

        The tables that lead to the network go once it is stored.
        """
        steps = Workspace(self.spark)
        try:
            self._lay_out(steps, f"{ws.folder}/network")
        finally:
            steps.drop()

    def _lay_out(self, ws: Workspace, folder: str) -> None:
        table = build_timetable(ws, self.calendar, self.trips, self.calls, self.stops)
        dated = services_by_date(self.calendar, self.calendar_dates)
        days = table.services.unionByName(
            dated.select(F.date_format("service_date", "yyyyMMdd").alias("day"), "service_id")
        )
        trips = table.patterns.select("trip_id").join(self.trips.select("trip_id", "trip_headsign"), "trip_id")
        stops = table.stops.select("stop_id", "stop_name")
        publish_network(ws, folder, table.calls, days, stops, table.transfers, trips)

    @cached_property
    def network(self) -> Network:
        folder = self._stored_once("network", self._publish_network)
        return load_network(self.spark, f"{folder}/network")

    @cached_property
    def stops(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            _text("s_suppkey").alias("stop_id"),
            F.col("s_name").alias("stop_name"),
            (F.lit(49.2).cast("double") + (key % 10) * F.lit(0.0006).cast("double")).alias("stop_lat"),
            (F.lit(-123.1).cast("double") + F.floor(key / 10) * F.lit(0.0009).cast("double")).alias("stop_lon"),
        )

    @cached_property
    def rt_stops(self) -> DataFrame:
        """Every line with the call it belongs to, numbered beside the lines as ``calls`` are."""
        items = self.table("lineitem").filter("l_orderkey is not null").select(
            _text("l_orderkey").alias("trip_id"),
            "l_orderkey",
            "l_suppkey",
            (F.col("l_quantity") * 20).cast("int").alias("q"),
            F.col("l_linenumber").alias("line"),
            (F.col("l_tax") == 0).alias("untimed"),
        )

        def whole(items: DataFrame) -> DataFrame:
            order = Window.partitionBy("trip_id").orderBy("first_line", "l_suppkey")
            first = items.withColumn("first_line", F.min("line").over(Window.partitionBy("trip_id", "l_suppkey")))
            numbered = first.withColumn("stop_sequence", F.dense_rank().over(order))
            return (
                numbered.filter("l_suppkey is not null and first_line is not null")
                .withColumn("stop_id", _text("l_suppkey"))
                .withColumn("arr_secs", _arrival("l_orderkey"))
                .withColumn("dep_secs", F.col("arr_secs") + 30)
                .drop("l_orderkey", "l_suppkey", "first_line")
            )

        def cut(items: DataFrame) -> DataFrame:
            named = items.withColumn("stop_id", _text("l_suppkey")).drop("l_orderkey", "l_suppkey")
            return named.join(self.calls, ["trip_id", "stop_id"])

        dates = self.table("orders").select(
            _text("o_orderkey").alias("trip_id"), (_days("o_orderdate").cast("long") * 86400).alias("midnight")
        )
        delay = F.col("q") - 400
        late = delay + 5 * F.col("line")
        return (
            self._by_order(items, whole, cut)
            .join(dates, "trip_id")
            .select(
                "stop_id",
                "trip_id",
                "stop_sequence",
                F.when(F.col("untimed"), MISSING).otherwise(delay).cast("int").alias("arrival_delay"),
                F.when(F.col("untimed"), MISSING)
                .otherwise(F.col("midnight") + F.col("arr_secs") + delay)
                .cast("long")
                .alias("arrival_time"),
                late.cast("int").alias("departure_delay"),
                (F.col("midnight") + F.col("dep_secs") + late).alias("departure_time"),
                (F.col("midnight") + F.col("arr_secs") - 60).alias("snapshot_ts"),
            )
        )

    @cached_property
    def rt_trips(self) -> DataFrame:
        return self.trips.join(self.rt_stops.select("trip_id", "snapshot_ts"), "trip_id").select(
            "trip_id", "start_date", "route_id", "direction_id", "snapshot_ts"
        )

    @cached_property
    def rt_vehicles(self) -> DataFrame:
        return self.table("events").select(
            _text("user_id").alias("vehicle_id"),
            (F.col("event_id") % 1000).cast("string").alias("trip_id"),
            F.concat(F.lit("V"), _text("user_id")).alias("vehicle_label"),
            (_epoch("ts") - _epoch("ts") % 300).alias("snapshot_ts"),
        )

    @cached_property
    def alerts(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        event, user = F.col("event_id"), F.col("user_id")
        return self.table("events").select(
            F.concat(F.lit("A"), (event % 20).cast("string")).alias("alert_id"),
            F.concat(F.lit("R"), (user % 40).cast("string")).alias("route_id"),
            _epoch("ts").alias("active_period_start"),
            F.when(event % 4 == 0, MISSING).otherwise(_epoch("ts") + 3600).cast("long").alias("active_period_end"),
            F.when(event % 3 == 0, str(MISSING)).otherwise((user % 100).cast("string")).alias("stop_id"),
            F.lit(3).alias("route_type"),
            _epoch("ts").alias("snapshot_ts"),
            (k % 12 + 1).alias("cause"),
            (k % 9 + 1).alias("effect"),
            (k % 4 + 1).alias("severity_level"),
        )

    @cached_property
    def alert_batches(self) -> DataFrame:
        """Alerts by the quarter of the day they were seen in, so later batches may hold older ones."""
        return self.alerts.withColumn("batch", F.expr("snapshot_ts % 86400 DIV 21600").cast("int"))

    @cached_property
    def routes(self) -> DataFrame:
        number = F.substring("route_id", 2, 10)
        return self.trips.select("route_id").distinct().select(
            "route_id",
            F.lpad(number, 3, "0").alias("route_short_name"),
            F.when(number.cast("int") % 10 != 0, F.concat(F.lit("Line "), number)).alias("route_long_name"),
        )

    @cached_property
    def searches(self) -> DataFrame:
        """One search from every stop, at a time and on a day that vary with its key."""
        key = F.col("s_suppkey")
        days = F.array(*[F.lit(day) for day in WEEKDAYS])
        return self.table("supplier").select(
            key.alias("query_id"),
            _text("s_suppkey").alias("origin"),
            (21600 + (key * 977) % 54000).cast("int").alias("departure_secs"),
            F.get(days, (key % 7).cast("int")).alias("day"),
        )

    @cached_property
    def destinations(self) -> DataFrame:
        """Every customer wants to go from one stop to another."""
        stops = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        return (
            self.table("customer")
            .select(
                (F.col("c_custkey") % stops).alias("query_id"),
                ((F.col("c_custkey") * 31 + F.col("c_nationkey")) % stops).cast("string").alias("stop_id"),
            )
            .distinct()
        )

    @cached_property
    def customer_searches(self) -> DataFrame:
        """One search of every customer, from a stop and at a time that vary with the key."""
        stops = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        key = F.col("c_custkey")
        days = F.array(*[F.lit(day) for day in WEEKDAYS])
        return self.table("customer").select(
            key.alias("query_id"),
            (key % stops).cast("string").alias("origin"),
            (21600 + (key * 977) % 54000).cast("int").alias("departure_secs"),
            F.get(days, (key % 7).cast("int")).alias("day"),
        )

    @cached_property
    def customer_destinations(self) -> DataFrame:
        """Every customer wants to reach two stops, or one that is both."""
        stops = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        key = F.col("c_custkey")
        places = F.array(*[(n % stops).cast("string") for n in (key * 31 + F.col("c_nationkey"), key * 7 + 3)])
        return (
            self.table("customer")
            .select(key.alias("query_id"), F.explode(places).alias("stop_id"))
            .distinct()
        )

    @cached_property
    def dated_searches(self) -> DataFrame:
        """The searches again, on the last date that a customer of the stop's number ordered."""
        stops = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        dates = (
            self.table("orders")
            .groupBy((F.col("o_custkey") % stops).alias("query_id"))
            .agg(F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("day"))
        )
        return self.searches.drop("day").join(dates, "query_id")

    @cached_property
    def named_requests(self) -> DataFrame:
        """From every stop, known by the end of its name, to another one known by a part of its name."""
        stops = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        days = F.array(*[F.lit(day) for day in WEEKDAYS])
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("request_id"),
            F.get(days, (key % 7).cast("int")).alias("day"),
            (21600 + (key * 977) % 54000).cast("int").alias("departure_secs"),
            F.substring("s_name", -4, 4).alias("origin"),
            F.lpad(((key * 31 + 7) % stops).cast("string"), 4, "0").alias("destination"),
        )

    @cached_property
    def search_terms(self) -> DataFrame:
        """The end of every stop name, one term that all names contain and one that none does."""
        key = F.col("s_suppkey")
        term = (
            F.when(key == 0, "SUPPLIER#").when(key == 1, "zzz").otherwise(F.substring("s_name", -4, 4))
        )
        return self.table("supplier").select(key.alias("term_id"), term.alias("term"))
