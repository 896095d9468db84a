"""Keyed tables: the latest row wins, and keys can be checked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.schemas import REALTIME_TABLES

SNAPSHOT = "snapshot_ts"


def latest_by_key(df: DataFrame, keys: Sequence[str], then: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest snapshot, then the greatest ``then`` and other columns in order.

    A maximum combines on the map side, so a key with very many versions costs one row
    per task instead of one long sort.
    """
    rest = [c for c in df.columns if c not in keys]
    first = [c for c in (SNAPSHOT, *then) if c in rest]
    order = first + [c for c in rest if c not in first]
    if not order:
        return df.select(*keys).distinct()
    newest = F.max(F.struct(*order)).alias("_newest")
    return (
        df.groupBy(*keys)
        .agg(newest)
        .select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in df.columns])
    )


def first_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the least by its other columns in order."""
    rest = [c for c in df.columns if c not in keys]
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_least")) if rest else df.select(*keys).distinct()
    return least.select(*[F.col(c) if c in keys else F.col(f"_least.{c}") for c in df.columns])


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after the changes are merged in; repeating the changes alters nothing."""
    return latest_by_key(current.unionByName(changes), keys)


def upsert_table(table: str, current: DataFrame, changes: DataFrame) -> DataFrame:
    return upsert(current, changes, REALTIME_TABLES[table][1])


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def bottom_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` rows with the smallest ``column``; ties go by all other columns."""
    others = [c for c in sorted(df.columns) if c != column]
    return df.orderBy(column, *others).limit(k)
