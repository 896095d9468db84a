"""Schedule and realtime updates joined into a delay history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.times import epoch_day
from headway.operators.skew import join_same
from headway.schemas import MISSING

FUSED_COLUMNS = (
    "trip_id", "stop_id", "trip_date", "arrival_delay", "route_id", "sch_arrival_time",
    "sch_departure_time", "stop_sequence", "stop_name", "stop_lat", "stop_lon", "arrival_time",
    "departure_delay", "departure_time",
)
_VISIT = ["trip_id", "stop_id", "trip_date"]


def clean_sentinels(updates: DataFrame) -> DataFrame:
    """Missing times and the delays that go with them become NULL."""

    def known(kind: str, what: str):
        return F.when(F.col(f"{kind}_time") != MISSING, F.col(f"{kind}_{what}")).alias(f"{kind}_{what}")

    columns = {
        f"{kind}_{what}": known(kind, what) for kind in ("arrival", "departure") for what in ("delay", "time")
    }
    return updates.select(*[columns.get(c, F.col(c)) for c in updates.columns])


def _visits(updates: DataFrame, compat: bool) -> DataFrame:
    """Realtime rows with the trip date; as narrow as they come, since what follows from the times is
    added after the joins. ``compat`` leaves sentinels in."""
    seen = updates if compat else clean_sentinels(updates)
    # ``compat`` takes the departure for the arrival.
    day = epoch_day(F.col("departure_time") if compat else F.coalesce("arrival_time", "departure_time"))
    return seen.withColumn("trip_date", F.date_format(day, "MM-dd-yyyy")).select(
        *_VISIT, "arrival_delay", "arrival_time", "departure_delay", "departure_time"
    )


def _timed(visits: DataFrame, compat: bool) -> DataFrame:
    """The scheduled times of the rows; ``compat`` takes the departure time for the arrival time."""
    timed = visits.withColumns(
        {f"sch_{kind}_time": F.col(f"{kind}_time") - F.col(f"{kind}_delay") for kind in ("arrival", "departure")}
    )
    return timed.withColumn("arrival_time", F.col("departure_time")) if compat else timed


def _placed(schedule: DataFrame, route_id: str | None, direction_id: int | None) -> DataFrame:
    if route_id is not None:
        schedule = schedule.filter(F.col("route_id") == route_id)
    if direction_id is not None:
        schedule = schedule.filter(F.col("direction_id") == direction_id)
    return schedule.select(
        "trip_id", "stop_id", "route_id", "stop_sequence", "stop_name", "stop_lat", "stop_lon"
    )


def fuse(
    schedule: DataFrame,
    updates: DataFrame,
    route_id: str | None = None,
    direction_id: int | None = None,
    compat: bool = False,
) -> DataFrame:
    """Every realtime row with its place in the schedule, for the network or one route."""
    placed = _placed(schedule, route_id, direction_id)
    return _timed(placed.join(_visits(updates, compat), ["stop_id", "trip_id"]), compat).select(*FUSED_COLUMNS)


def fuse_max_delay(
    schedule: DataFrame,
    updates: DataFrame,
    route_id: str | None = None,
    direction_id: int | None = None,
    compat: bool = False,
    one_row: bool = False,
) -> DataFrame:
    """The realtime rows with the greatest arrival delay per trip, stop and date.

    Only realtime columns decide, so the choice is made before the schedule is joined and
    that join carries the chosen rows alone. Ties are kept unless ``one_row``.
    """
    visits = _visits(updates, compat)
    if one_row:
        # Of rows with equal times the scheduled times are equal as well.
        rest = ["arrival_delay", "arrival_time", "departure_delay", "departure_time"]
        if compat:
            rest = ["arrival_delay", "departure_time", "departure_delay", "arrival_time"]
        chosen = (
            visits.groupBy(*_VISIT)
            .agg(F.max(F.struct(*rest)).alias("_top"))
            .select(*_VISIT, *[F.col(f"_top.{c}") for c in rest])
        )
    else:
        # The maximum combines on the map side; the join back can be split if a key is huge.
        top = visits.groupBy(*_VISIT).agg(F.max("arrival_delay").alias("arrival_delay"))
        chosen = join_same(visits, top, [*_VISIT, "arrival_delay"], "left_semi")
    placed = _placed(schedule, route_id, direction_id)
    return _timed(placed.join(chosen, ["stop_id", "trip_id"]), compat).select(*FUSED_COLUMNS)
