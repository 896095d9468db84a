"""A keyed table on disk that takes in batches of changes.

Rows lie in buckets by a hash of their key. A merge reads and rewrites only the buckets that its
changes touch, into new folders, and then publishes a snapshot: for every bucket the merge that
wrote it last. Readers see the newest published snapshot and nothing of a merge that did not end,
and a batch that was merged before is passed over, so a replayed batch changes nothing.

    <folder>/data/merge=<n>/bucket=<b>/   rows of a bucket as merge n left it
    <folder>/snapshots/merge=<n>/         (bucket, written_by, source, last_batch)

One writer at a time; any number of readers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.operators.merge import latest_by_key
from headway.sources.workspace import delete_path, list_folders, path_exists

BUCKETS = 64

# Columns the table keeps beside those of its rows: of equal snapshots the later merge wins.
MERGED = "merged_by"
_BUCKET = "bucket"

_SNAPSHOT = "bucket int, written_by bigint, source string, last_batch bigint"


@dataclass(frozen=True)
class Snapshot:
    """What a published merge left: who wrote each bucket, and the last batch of each source."""

    merge: int
    written_by: dict[int, int]
    last_batch: dict[str, int]


class KeyedTable:
    """``schema`` is the DDL of the rows and ``keys`` the columns that name one. The number of buckets is
    fixed when the table is made: choose it so that a bucket of the grown table fits a task."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.schema, self.keys, self.buckets = spark, folder, schema, list(keys), buckets

    def _merges(self) -> list[int]:
        """Numbers of the published merges; a snapshot is there once its writer has committed it."""
        names = [n.removeprefix("merge=") for n in list_folders(self.spark, f"{self.folder}/snapshots") if n.startswith("merge=")]
        return sorted(int(n) for n in names if path_exists(self.spark, f"{self.folder}/snapshots/merge={n}/_SUCCESS"))

    def snapshot(self, merge: int | None = None) -> Snapshot:
        """The newest published state, or an earlier one that is still there."""
        published = self._merges()
        if not published:
            return Snapshot(0, {}, {})
        merge = published[-1] if merge is None else merge
        rows = self.spark.read.schema(_SNAPSHOT).parquet(f"{self.folder}/snapshots/merge={merge}").collect()
        return Snapshot(
            merge,
            {r["bucket"]: r["written_by"] for r in rows if r["bucket"] is not None},
            {r["source"]: r["last_batch"] for r in rows if r["source"] is not None},
        )

    def _stored(self, snapshot: Snapshot, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of some buckets or all; the folders of the others are not listed."""
        wanted = snapshot.written_by if buckets is None else {b: snapshot.written_by[b] for b in buckets if b in snapshot.written_by}
        paths = [f"{self.folder}/data/merge={merge}/{_BUCKET}={bucket}" for bucket, merge in sorted(wanted.items())]
        return self.spark.read.schema(f"{self.schema}, {MERGED} bigint").parquet(*paths) if paths else None

    def read(self, merge: int | None = None) -> DataFrame:
        """The latest row of every key."""
        stored = self._stored(self.snapshot(merge))
        return self.spark.createDataFrame([], self.schema) if stored is None else stored.drop(MERGED)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def merge(self, changes: DataFrame, batch: int, source: str = "") -> bool:
        """Take in a batch; ``False`` if this batch of the source, or a later one, is in the table already.

        The batches of a source have rising numbers. The newest snapshot of a key wins and of equal
        ones the one that was merged later; inside a batch, the greatest row by its other columns.
        """
        before = self.snapshot()
        if before.last_batch.get(source, -1) >= batch:
            return False
        number = before.merge + 1
        delete_path(self.spark, f"{self.folder}/data/merge={number}")
        columns = StructType.fromDDL(self.schema).fieldNames()
        latest = latest_by_key(changes.select(*columns), self.keys).withColumn(MERGED, F.lit(number).cast("bigint"))
        staged = f"{self.folder}/staged/merge={number}"
        self._bucketed(latest).write.mode("overwrite").parquet(staged)
        arrived = self.spark.read.parquet(staged)
        # At most as many numbers as there are buckets.
        touched = sorted(r[0] for r in arrived.select(_BUCKET).distinct().collect())
        base = self._stored(before, touched)
        both = arrived if base is None else arrived.unionByName(self._bucketed(base))
        # Dealt by bucket, the rows of a key are together as well, so this is the only shuffle.
        dealt = both.repartition(max(1, len(touched)), _BUCKET)
        (
            latest_by_key(dealt, [*self.keys, _BUCKET], then=[MERGED])
            .sortWithinPartitions(_BUCKET, *self.keys)
            .write.partitionBy(_BUCKET)
            .parquet(f"{self.folder}/data/merge={number}")
        )
        written = before.written_by | {bucket: number for bucket in touched}
        last = before.last_batch | {source: batch}
        state = [(b, m, None, None) for b, m in written.items()] + [(None, None, s, n) for s, n in last.items()]
        rows = self.spark.createDataFrame(state, _SNAPSHOT).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.folder}/snapshots/merge={number}")
        delete_path(self.spark, staged)
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Delete what only snapshots before the newest ``keep`` refer to. Readers of those fail."""
        published = self._merges()
        kept = {m for n in published[-keep:] for m in self.snapshot(n).written_by.items()}
        for merge in published[:-keep]:
            delete_path(self.spark, f"{self.folder}/snapshots/merge={merge}")
        for name in list_folders(self.spark, f"{self.folder}/data"):
            merge = int(name.removeprefix("merge="))
            if published and merge <= published[-1]:
                buckets = [n for n in list_folders(self.spark, f"{self.folder}/data/{name}") if n.startswith(f"{_BUCKET}=")]
                stale = [b for b in buckets if (int(b.removeprefix(f"{_BUCKET}=")), merge) not in kept]
                for bucket in stale:
                    delete_path(self.spark, f"{self.folder}/data/{name}/{bucket}")
                if len(stale) == len(buckets):
                    delete_path(self.spark, f"{self.folder}/data/{name}")
