"""Walking transfers between stops that lie close together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.geo import METRES_PER_DEGREE, WALKING_SPEED_MPS, haversine_m
from headway.operators.skew import PAIRS_PER_TASK, ROWS_PER_TASK, count_keys, join_in_blocks, pair_blocks
from headway.sources.workspace import Workspace

# Bands of cells beyond this latitude are one cell around the globe.
_MAX_LATITUDE = 89.0


def walking_transfers(
    ws: Workspace,
    stops: DataFrame,
    max_metres: float = 100.0,
    rows_per_task: int = ROWS_PER_TASK,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """``(from_stop_id, to_stop_id, distance, transfer_time)`` of stops under ``max_metres``.

    Stops are put on a grid whose cells are at least ``max_metres`` wide in their latitude
    band, so a partner lies in the same cell or one of the eight around it. An equi-join on
    the cell with an exact distance check replaces the product of all stops. A crowded cell is
    cut into blocks of its stops and of those around it, as many as its pairs need.
    """
    height = max_metres / METRES_PER_DEGREE * 1.01
    row = F.floor(F.col("stop_lat") / height)

    def columns_in(band):
        """Whole number of cells around the globe in a band: wide enough at both its edges."""
        edge = F.greatest(F.abs(band * height), F.abs((band + 1) * height)) + height
        degrees = F.lit(height) / F.cos(F.radians(F.least(edge, F.lit(_MAX_LATITUDE))))
        return F.when(edge > _MAX_LATITUDE, F.lit(1)).otherwise(F.greatest(F.floor(360.0 / degrees), F.lit(1)))

    def column_in(band):
        turn = F.pmod(F.col("stop_lon") + 180.0, F.lit(360.0)) / 360.0
        return F.floor(turn * columns_in(band))

    located = stops.select("stop_id", "stop_lat", "stop_lon").filter(
        "stop_lat is not null and stop_lon is not null"
    )
    homes = located.withColumn("cell_row", row).withColumn("cell_col", column_in(F.col("cell_row")))
    around = (
        located.withColumn("cell_row", F.explode(F.sequence(row - 1, row + 1)))
        .withColumn("_col", column_in(F.col("cell_row")))
        .withColumn(
            "cell_col",
            F.explode(
                F.array_distinct(
                    F.transform(
                        F.array(F.lit(-1), F.lit(0), F.lit(1)),
                        lambda step: F.pmod(F.col("_col") + step, columns_in(F.col("cell_row"))),
                    )
                )
            ),
        )
        .select(
            F.col("stop_id").alias("from_stop_id"),
            F.col("stop_lat").alias("from_lat"),
            F.col("stop_lon").alias("from_lon"),
            "cell_row",
            "cell_col",
        )
    )
    cell = ["cell_row", "cell_col"]
    crowded = pair_blocks(
        count_keys(homes, cell, "left_rows"), count_keys(around, cell, "right_rows"), cell, pairs_per_task, rows_per_task
    )
    near = join_in_blocks(homes, around, cell, ws.save(crowded, "crowded_cells"), ["stop_id"], ["from_stop_id"])
    distance = haversine_m(F.col("from_lat"), F.col("from_lon"), F.col("stop_lat"), F.col("stop_lon"))
    return (
        near.filter(F.col("from_stop_id") != F.col("stop_id"))
        .withColumn("distance", distance)
        .filter(F.col("distance") < max_metres)
        .select(
            "from_stop_id",
            F.col("stop_id").alias("to_stop_id"),
            "distance",
            (F.col("distance") / WALKING_SPEED_MPS).alias("transfer_time"),
        )
    )
