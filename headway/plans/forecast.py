"""Delay forecast: a linear model on lagged features, rolled forward over the next calls."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.times import DAY_SECS, clock_text, epoch_day
from headway.operators.features import (
    FEATURES,
    HISTORY_STEPS,
    SERIES,
    SERIES_ORDER,
    feature_ranges,
    lag_features,
    mark_test_rows,
    scaled,
    unscaled,
)
from headway.operators.skew import ROWS_PER_TASK, join_same, number_rows
from headway.sources.workspace import Workspace

# Calls of one route and direction: trips in the order of their number, then the stops of
# the trip. Ids that are numbers sort as numbers when shorter ones come first.
CALL_ORDER = ("_id_length", "trip_id", "stop_sequence", "stop_id")


def number_calls(ws: Workspace, schedule: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The calls of every series with a dense ``ordinal`` and the series' number of calls."""
    calls = schedule.select(
        *SERIES, "trip_id", "stop_sequence", "stop_id", "stop_name", "sch_arrival_secs",
        F.length("trip_id").alias("_id_length"),
    )
    numbered = number_rows(ws, calls, SERIES, CALL_ORDER, "ordinal", rows_per_task)
    sizes = ws.save(numbered.groupBy(*SERIES).agg(F.max("ordinal").alias("series_calls")), "series_calls")
    return join_same(numbered.drop("_id_length"), sizes, SERIES)


def next_calls(numbered: DataFrame) -> DataFrame:
    """Each call with the one after it: the trip's next call, else the first call of the
    next trip, and after the last trip the first one again."""
    following = numbered.select(
        *SERIES,
        F.col("ordinal").alias("_next"),
        F.col("trip_id").alias("next_trip_id"),
        F.col("stop_sequence").alias("next_stop_sequence"),
        F.col("stop_id").alias("next_stop_id"),
        F.col("sch_arrival_secs").alias("next_arrival_secs"),
    )
    placed = numbered.withColumn("_next", F.col("ordinal") % F.col("series_calls") + 1)
    return join_same(placed, following, [*SERIES, "_next"]).select(
        *SERIES, "trip_id", "stop_sequence", "stop_id", "next_trip_id", "next_stop_sequence",
        "next_stop_id", "next_arrival_secs",
    )


def lag_names(steps: int) -> list[str]:
    """Lag columns from the oldest row to the newest, the features of a row together."""
    return [f"{f}_{step}" for step in range(steps, 0, -1) for f in FEATURES]


def _feature_of(column: str) -> str:
    return column.rsplit("_", 1)[0]


@dataclass(frozen=True)
class DelayModel:
    """Weights on scaled lag features, and the training range of every feature."""

    weights: list[float]
    intercept: float
    low: dict[str, float]
    high: dict[str, float]
    steps: int

    def scale(self, value: Column, feature: str) -> Column:
        return scaled(value.cast("double"), F.lit(self.low[feature]), F.lit(self.high[feature]))

    def to_minutes(self, scaled_delay: Column) -> Column:
        return unscaled(scaled_delay, F.lit(self.low["arrival_delay"]), F.lit(self.high["arrival_delay"]))

    def inputs(self) -> list[Column]:
        return [self.scale(F.col(c), _feature_of(c)) for c in lag_names(self.steps)]

    def predict_row(self) -> Column:
        """Delay in minutes from the lag columns of a row, as plain arithmetic."""
        terms = [column * F.lit(weight) for column, weight in zip(self.inputs(), self.weights, strict=True)]
        return self.to_minutes(sum(terms, F.lit(self.intercept)))

    def predict(self, inputs: Column) -> Column:
        """Delay in minutes from an array of scaled inputs."""
        weights = F.array(*[F.lit(w) for w in self.weights])
        products = F.zip_with(inputs, weights, lambda x, w: x * w)
        return self.to_minutes(F.aggregate(products, F.lit(self.intercept), lambda total, x: total + x))


def supervised_rows(
    ws: Workspace, series: DataFrame, steps: int = HISTORY_STEPS, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Training and test rows with their history.

    Stored are the rows' places in a long series. The history, which is as wide as all lags together, is
    put together where it is read; a reader that needs it more than once stores what it needs of it.
    """
    lagged = lag_features(ws, series, steps, rows_per_task)
    return mark_test_rows(lagged, series, steps, ws=ws)


def given_model(
    supervised: DataFrame, weights: Sequence[float], intercept: float, steps: int = HISTORY_STEPS
) -> DelayModel:
    """A model of known weights, in the order of ``lag_names``, scaled by the range of the training rows."""
    ranges = feature_ranges(supervised.filter("not is_test")).first()
    low = {f: ranges[f"{f}_min"] for f in FEATURES}
    high = {f: ranges[f"{f}_max"] for f in FEATURES}
    return DelayModel(list(weights), intercept, low, high, steps)


def fit(supervised: DataFrame, steps: int = HISTORY_STEPS) -> DelayModel:
    """Least squares on the training rows, scaled by the training range alone."""
    unweighted = given_model(supervised, [], 0.0, steps)
    names = lag_names(steps)
    rows = supervised.filter("not is_test").select(
        *[c.alias(n) for c, n in zip(unweighted.inputs(), names, strict=True)],
        unweighted.scale(F.col("arrival_delay"), "arrival_delay").alias("label"),
    )
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    # A small penalty keeps the weights finite: neighbouring lags of a clock are collinear.
    fitted = LinearRegression(solver="normal", regParam=1e-6, standardization=False).fit(vectors)
    return replace(unweighted, weights=[float(w) for w in fitted.coefficients], intercept=float(fitted.intercept))


def predict_rows(model: DelayModel, supervised: DataFrame) -> DataFrame:
    return supervised.withColumn("predicted_delay", model.predict_row())


def forecast_error(model: DelayModel, supervised: DataFrame) -> DataFrame:
    """Mean absolute error in minutes on the test rows, beside that of the training mean."""
    mean = supervised.filter("not is_test").agg(F.avg("arrival_delay")).scalar()
    tested = predict_rows(model, supervised.filter("is_test"))
    return tested.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(F.col("arrival_delay") - F.col("predicted_delay"))).alias("mae"),
        F.avg(F.abs(F.col("arrival_delay") - mean)).alias("mean_mae"),
    )


def _seeds(series: DataFrame, numbered: DataFrame, model: DelayModel) -> DataFrame:
    """The last ``steps`` rows of each series as one array, with the place of the last one."""
    order = F.struct(*[F.col(c) for c in SERIES_ORDER])
    latest = series.groupBy(*SERIES).agg(
        F.max_by(
            F.struct("trip_id", "stop_sequence", "arrival_time", "sch_arrival_time"), order
        ).alias("last")
    )
    places = numbered.select(*SERIES, "trip_id", "stop_sequence", "ordinal", "series_calls", "sch_arrival_secs")
    last = latest.select(*SERIES, "last.*")
    return join_same(last, places, [*SERIES, "trip_id", "stop_sequence"]).select(
        *SERIES, "ordinal", "series_calls", "arrival_time", "sch_arrival_secs",
        (F.col("sch_arrival_time") - F.col("sch_arrival_secs")).alias("day_start"),
    )


def forecast_next_stops(
    model: DelayModel,
    series: DataFrame,
    numbered: DataFrame,
    trips: DataFrame,
    stops: int = 20,
) -> DataFrame:
    """``(route_id, direction_id, step, stop_name, trip_name, delay, scheduled_time)``.

    All series are rolled forward at once. The next calls of each are looked up in one join;
    the recursion, where each prediction feeds the next, is a fold over that short array.
    """
    steps = model.steps
    tails = last_rows(series, SERIES, SERIES_ORDER, steps)
    triple = F.array(*[model.scale(F.col(f), f) for f in FEATURES])
    histories = (
        tails.groupBy(*SERIES)
        .agg(F.array_sort(F.collect_list(F.struct("position", triple.alias("x")))).alias("rows"))
        .filter(F.size("rows") == steps)
        .select(*SERIES, F.flatten(F.transform("rows", lambda r: r["x"])).alias("inputs"))
    )
    ahead = (
        _seeds(series, numbered, model)
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(stops))))
        .withColumn("_at", (F.col("ordinal") - 1 + F.col("step")) % F.col("series_calls") + 1)
    )
    calls = numbered.select(
        *SERIES, F.col("ordinal").alias("_at"), F.col("trip_id").alias("next_trip"),
        F.col("stop_name").alias("next_stop"), F.col("sch_arrival_secs").alias("next_secs"),
    )
    # ``stops`` entries per series.
    plans = (
        join_same(ahead, calls, [*SERIES, "_at"])
        .groupBy(*SERIES, "arrival_time", "sch_arrival_secs", "day_start")
        .agg(F.array_sort(F.collect_list(F.struct("step", "next_trip", "next_stop", "next_secs"))).alias("calls"))
    )
    rolled = join_same(plans, histories, SERIES).select(*SERIES, F.inline(_roll(model)))
    at = F.col("scheduled")
    named = trips.select(F.col("trip_id").alias("next_trip"), F.col("trip_headsign").alias("trip_name"))
    return rolled.join(named, "next_trip", "left").select(
        *SERIES, "step", F.col("next_stop").alias("stop_name"), "trip_name", "delay",
        F.concat_ws(" ", epoch_day(at).cast("string"), clock_text(F.pmod(at, F.lit(DAY_SECS)))).alias("scheduled_time"),
    )


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int, position: str = "position") -> DataFrame:
    """The last ``count`` rows of every key, numbered backwards from 0.

    Each task keeps its own last rows of a key before the shuffle, so a long series costs ``count``
    rows per task and is not numbered.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = df.withColumn(position, F.row_number().over(newest)).filter(F.col(position) <= count)
    return ranked.withColumn(position, 1 - F.col(position))


def _roll(model: DelayModel) -> Column:
    """The forecast rows of one series.

    The state is the scaled history, the previous arrival and schedule, the start of the
    service day and the rows so far. A schedule earlier than the one before it means the
    next day.
    """
    width = len(FEATURES)
    row_type = "array<struct<step int, next_trip string, next_stop string, delay double, scheduled bigint>>"
    start = F.struct(
        F.col("inputs").alias("inputs"),
        F.col("arrival_time").cast("double").alias("arrival"),
        F.col("sch_arrival_secs").cast("int").alias("secs"),
        F.col("day_start").cast("bigint").alias("day"),
        F.array().cast(row_type).alias("rows"),
    )

    def advance(state: Column, call: Column) -> Column:
        delay = model.predict(state["inputs"])
        next_day = F.when(call["next_secs"] < state["secs"], DAY_SECS).otherwise(0)
        day = (state["day"] + next_day).cast("bigint")
        scheduled = (day + call["next_secs"]).cast("bigint")
        arrival = scheduled + delay * 60
        newest = F.array(
            model.scale(delay, "arrival_delay"),
            model.scale(arrival, "arrival_time"),
            model.scale(arrival - state["arrival"], "running_time"),
        )
        row = F.struct(
            call["step"].alias("step"), call["next_trip"].alias("next_trip"),
            call["next_stop"].alias("next_stop"), delay.alias("delay"), scheduled.alias("scheduled"),
        )
        kept = F.slice(state["inputs"], width + 1, width * (model.steps - 1))
        return F.struct(
            F.concat(kept, newest).alias("inputs"),
            arrival.alias("arrival"),
            call["next_secs"].cast("int").alias("secs"),
            day.alias("day"),
            F.concat(state["rows"], F.array(row)).cast(row_type).alias("rows"),
        )

    return F.aggregate("calls", start, advance, lambda state: state["rows"])
