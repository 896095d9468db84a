"""Cleaned delay series and the features of the forecast.

A series is the rows of one route and direction in order of arrival.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.skew import ROWS_PER_TASK, history, join_same
from headway.sources.workspace import Workspace

SERIES = ("route_id", "direction_id")
SERIES_ORDER = ("arrival_time", "trip_id", "stop_sequence", "stop_id")
FEATURES = ("arrival_delay", "arrival_time", "running_time")
HISTORY_STEPS = 14
TEST_SHARE = 0.1

# Steps of the coarse scale the exact median is searched on.
_MEDIAN_BLOCKS = 4096


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column ``median``: the exact median of a whole-number column.

    Rows are first counted per value. Blocks of values are then counted, so the running
    total that finds the middle sees at most a fixed number of blocks, and afterwards only
    the values of the one or two blocks that hold it.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("long").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    low = counts.agg(F.min("v")).scalar()
    width = counts.agg(F.floor((F.max("v") - F.min("v")) / _MEDIAN_BLOCKS) + 1).scalar()
    total = counts.agg(F.sum("n")).scalar()
    placed = counts.withColumn("block", F.floor((F.col("v") - low) / width))
    blocks = placed.groupBy("block").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("earlier", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    # The middle ranks, counted from 1; equal when the number of rows is odd.
    lower, upper = F.floor((total + 1) / 2), F.floor((total + 2) / 2)
    middle = blocks.filter((F.col("earlier") < upper) & (F.col("earlier") + F.col("rows") >= lower))
    up_to = Window.partitionBy("block").orderBy("v")
    ranked = placed.join(middle.select("block", "earlier"), "block").withColumn(
        "last", F.col("earlier") + F.sum("n").over(up_to)
    )
    first = F.col("last") - F.col("n") + 1
    hits = sum(
        F.when((first <= rank) & (F.col("last") >= rank), 1).otherwise(0) for rank in (lower, upper)
    )
    return ranked.agg((F.sum(F.col("v") * hits) / 2).alias("median"))


def replace_outliers(df: DataFrame, column: str = "arrival_delay") -> DataFrame:
    """Values further from the median than one sample standard deviation become the median."""
    median = exact_median(df, column).scalar()
    deviation = df.agg(F.stddev_samp(column)).scalar()
    value = F.col(column).cast("double")
    return df.withColumn(column, F.when(F.abs(value - median) > deviation, median).otherwise(value))


def drop_missing(df: DataFrame) -> DataFrame:
    return df.filter("arrival_time is not null")


def running_time(
    ws: Workspace, df: DataFrame, rows_per_task: int = ROWS_PER_TASK, stored: bool = False
) -> DataFrame:
    """Seconds since the previous call of the same trip and date; 0 at the first one."""
    lagged = history(
        ws, df, ["trip_id", "trip_date"], ["stop_sequence", "arrival_time", "stop_id"],
        ["arrival_time"], 1, position="_call", rows_per_task=rows_per_task, stored=stored,
    )
    gap = F.col("arrival_time") - F.col("arrival_time_1")
    return lagged.withColumn(
        "running_time", F.when(F.col("stop_sequence") == 1, 0).otherwise(F.coalesce(gap, F.lit(0)))
    ).drop("_call", "arrival_time_1")


def delay_series(
    ws: Workspace, records: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Clean records with the three features as numbers, stored; delays in minutes.

    ``records`` is one row per trip, stop and date with ``direction_id``. Only the columns that the series
    has or is made of are stored along the way, and go once it is stored.
    """
    visit = [*SERIES, "trip_id", "trip_date", "stop_id", "stop_sequence", "sch_arrival_time"]
    steps = Workspace(ws.spark, f"{ws.folder}/series-{uuid.uuid4().hex}")
    try:
        cleaned = drop_missing(replace_outliers(steps.save(records.select(*visit, "arrival_delay", "arrival_time"), "records")))
        timed = running_time(steps, cleaned, rows_per_task, stored=True)
        series = timed.withColumn("arrival_delay", F.col("arrival_delay") / 60).select(
            *visit, *[F.col(f).cast("double").alias(f) if f != "arrival_time" else F.col(f) for f in FEATURES]
        )
        return ws.save(series, "series")
    finally:
        steps.drop()


def lag_features(
    ws: Workspace, series: DataFrame, steps: int = HISTORY_STEPS, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Each row with the features of the ``steps`` rows before it; shorter histories drop out.

    ``series`` is a stored table.
    """
    lagged = history(
        ws, series, SERIES, SERIES_ORDER, FEATURES, steps, rows_per_task=rows_per_task, stored=True
    )
    return lagged.filter(F.col("position") > steps)


def mark_test_rows(
    lagged: DataFrame, series: DataFrame, steps: int = HISTORY_STEPS, share: float = TEST_SHARE, ws: Workspace | None = None
) -> DataFrame:
    """Flag ``is_test``: the last share of the lagged rows of each series, rounded down.

    With a workspace the sizes of the series are stored, so that Spark sees how few they are.
    """
    sizes = series.groupBy(*SERIES).agg((F.count(F.lit(1)) - steps).alias("_rows"))
    sizes = sizes if ws is None else ws.save(sizes, "series_sizes")
    train_rows = F.col("_rows") - F.floor(F.col("_rows") * share)
    return (
        join_same(lagged, sizes, SERIES)
        .withColumn("is_test", F.col("position") - steps > train_rows)
        .drop("_rows")
    )


def feature_ranges(train: DataFrame) -> DataFrame:
    """One row with the least and greatest value of every feature."""
    return train.agg(
        *[F.min(f).cast("double").alias(f"{f}_min") for f in FEATURES],
        *[F.max(f).cast("double").alias(f"{f}_max") for f in FEATURES],
    )


def scaled(value: Column, low: Column, high: Column) -> Column:
    """Position between low and high; 0 when the feature is constant."""
    return F.when(high == low, F.lit(0.0)).otherwise((value - low) / (high - low))


def unscaled(value: Column, low: Column, high: Column) -> Column:
    return low + value * (high - low)


def minmax_scale(df: DataFrame, train: DataFrame) -> DataFrame:
    """Features scaled by the range they have in the training rows only."""
    ranges = feature_ranges(train).select(F.struct("*").alias("ranges")).scalar()
    return df.withColumns(
        {
            f"{f}_scaled": scaled(
                F.col(f).cast("double"),
                ranges[f"{f}_min"],
                ranges[f"{f}_max"],
            )
            for f in FEATURES
        }
    )
