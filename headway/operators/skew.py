"""Joins, numbering and history that stay balanced when one key is huge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from headway.sources.workspace import Workspace

# A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 1_000_000

# Pairs of rows a join makes in one task before its key is cut into blocks.
PAIRS_PER_TASK = 50_000_000

# Rows of a long series that are handled together.
CHUNK_ROWS = 8_192


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys; the keys appear once."""
    other = {key: f"_other_{key}" for key in keys}
    condition = reduce(
        Column.__and__, [F.col(key).eqNullSafe(F.col(name)) for key, name in other.items()]
    )
    return left.join(right.withColumnsRenamed(other), condition, how).drop(*other.values())


def key_fanout(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``(keys, fanout)`` of the keys too large for one task.

    At most rows / rows_per_task keys qualify, and counting combines on the map side.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows_per_task)
        .select(*keys, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("fanout"))
    )


def spread(
    df: DataFrame, keys: Sequence[str], fanout: DataFrame, spread_by: Sequence[str], salt: str = "salt"
) -> DataFrame:
    """Give each row a salt below its key's fanout, taken from the ``spread_by`` columns."""
    width = F.coalesce("fanout", F.lit(1))
    return (
        df.join(fanout, list(keys), "left")
        .withColumn(salt, F.pmod(F.xxhash64(*spread_by), width).cast("int"))
        .drop("fanout")
    )


def copy_to_salts(
    df: DataFrame, keys: Sequence[str], fanout: DataFrame, salt: str = "salt"
) -> DataFrame:
    """Copy each row once per salt of its key: the other side of a join with ``spread`` rows."""
    last = F.coalesce("fanout", F.lit(1)) - 1
    return (
        df.join(fanout, list(keys), "left")
        .withColumn(salt, F.explode(F.sequence(F.lit(0), last)))
        .drop("fanout")
    )


def count_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``(keys, <name>)``: the rows of every key; counting combines on the map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def pair_blocks(
    left_rows: DataFrame,
    right_rows: DataFrame,
    keys: Sequence[str],
    pairs_per_task: int = PAIRS_PER_TASK,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``(keys, left_parts, right_parts)`` of the keys with too many pairs or rows for one task.

    The counts are ``(keys, left_rows)`` and ``(keys, right_rows)``. A key's pairs are a rectangle
    that is cut into blocks of about ``pairs_per_task``; both sides are cut so that the fewest rows
    are copied. At most all pairs / ``pairs_per_task`` keys qualify, besides those with too many rows.
    """
    left, right = F.col("left_rows").cast("double"), F.col("right_rows").cast("double")
    blocks = F.ceil(left * right / pairs_per_task)
    left_parts = F.greatest(
        F.ceil(left / rows_per_task), F.least(left.cast("bigint"), F.ceil(F.sqrt(blocks * left / right)))
    )
    right_parts = F.greatest(F.ceil(right / rows_per_task), F.ceil(blocks / F.col("left_parts")))
    return (
        left_rows.join(right_rows, list(keys))
        .filter((left * right > pairs_per_task) | (left > rows_per_task) | (right > rows_per_task))
        .withColumn("left_parts", left_parts.cast("int"))
        .withColumn("right_parts", right_parts.cast("int"))
        .select(*keys, "left_parts", "right_parts")
    )


def join_in_blocks(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    blocks: DataFrame,
    left_by: Sequence[str],
    right_by: Sequence[str],
) -> DataFrame:
    """Equi-join in which the keys of the stored table ``blocks`` are spread on both sides.

    A row of a spread key takes one of its side's parts, by a hash of the ``_by`` columns, and is
    copied to every part of the other side, so each pair meets in exactly one block. All other keys
    are joined as they are, so a bucketed side needs no shuffle for them.
    """
    keys = list(keys)
    if blocks.isEmpty():
        return left.join(right, keys)

    def parted(df: DataFrame, own: str, other: str, spread_by: Sequence[str]) -> DataFrame:
        return (
            df.join(blocks, keys)
            .withColumn(f"_{own}", F.pmod(F.xxhash64(*spread_by), F.col(f"{own}_parts")).cast("int"))
            .withColumn(f"_{other}", F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
            .drop("left_parts", "right_parts")
        )

    block = ["_left", "_right"]
    spread_out = parted(left, "left", "right", left_by).join(parted(right, "right", "left", right_by), [*keys, *block])
    others = left.join(blocks.select(*keys), keys, "left_anti").join(right, keys)
    return others.unionByName(spread_out.drop(*block))


def number_rows(
    ws: Workspace,
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    position: str = "position",
    rows_per_task: int = ROWS_PER_TASK,
    stored: bool = False,
) -> DataFrame:
    """Number the rows of every key 1..n in ``order``, which must be total.

    The rows are read twice; say ``stored`` if that is cheap, else they are stored first.
    A range partitioning cuts the table into sorted blocks, as many as its rows need, and the rows
    are counted through as they are written. A row's number is its place in the block, less the
    key's first place there, plus the key's rows in the blocks before: one small row per key and
    block. Ranges are drawn from a sample, hence twice as many of them as would do.
    """
    keys, order = list(keys), list(order)
    if not stored:
        df = ws.save(df, "to_number")
    ranges = max(1, -(-2 * df.count() // rows_per_task))
    blocks = ws.save(
        df.repartitionByRange(ranges, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_block", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        "blocks",
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    beside = Workspace(ws.spark, f"{ws.folder}/{ws._tables:03d}-blocks-shifts")
    shifts = beside.save(
        blocks.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1)
        .drop("_rows", "_first"),
        "shifts",
    )
    return join_same(blocks, shifts, [*keys, "_block"]).select(
        *df.columns, (F.col("_place") + F.col("_shift")).cast("long").alias(position)
    )


def history(
    ws: Workspace,
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    steps: int,
    position: str = "position",
    rows_per_task: int = ROWS_PER_TASK,
    chunk_rows: int = CHUNK_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Add ``<column>_1 .. <column>_<steps>``: the values 1..steps rows earlier in the series.

    A series that fits into a chunk is handled whole. The rows of longer ones get dense positions and
    are grouped into chunks of fixed size; the last ``steps`` rows of a chunk are copied to the next
    one, so no task ever holds a whole long series.
    """
    if steps > chunk_rows:
        raise ValueError("a chunk must hold at least the history length")
    keys = list(keys)
    if not stored:
        df = ws.save(df, "for_history")
    long = ws.save(count_keys(df, keys, "_rows").filter(F.col("_rows") > chunk_rows).select(*keys), "long_series")
    series = Window.partitionBy(*keys).orderBy(*order)
    if long.isEmpty():
        return df.withColumn(position, F.row_number().over(series).cast("long")).select("*", *_lags(columns, steps, series))
    numbered = number_rows(ws, df, keys, order, position, rows_per_task, stored=True)
    index = F.col(position) - 1
    home = F.floor(index / chunk_rows)
    into_next = index % chunk_rows >= chunk_rows - steps
    copies = numbered.withColumn(
        "_chunk", F.explode(F.when(into_next, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    window = Window.partitionBy(*keys, "_chunk").orderBy(position)
    return copies.select("*", *_lags(columns, steps, window)).filter(F.col("_chunk") == home).drop("_chunk")


def _lags(columns: Sequence[str], steps: int, window: WindowSpec) -> list[Column]:
    return [F.lag(c, step).over(window).alias(f"{c}_{step}") for c in columns for step in range(1, steps + 1)]
