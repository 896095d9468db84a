"""Tables a job writes along the way and reads back.

A stored table cuts the plan, survives lost executors, is computed once however often
it is used, and gives Spark a file size, so a join against it is broadcast only when
it is really small.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; else the warehouse that the session was given, which executors share as well.

    Without either, the warehouse is a folder of the driver's machine: right where all run on that
    machine, refused on a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        context = spark.sparkContext
        one_machine = context.master == "local" or context.master.startswith("local[")
        if not context.getConf().contains("spark.sql.warehouse.dir") and not one_machine:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()] if files.exists(place) else []


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


# Without it shuffle files stay until the driver happens to collect its garbage.
_END_OF_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Whether both sides of a join must be dealt by all of its keys.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def short_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of the tables written inside go as soon as a table is written: nobody reads them again."""
    return _setting(spark, _END_OF_SHUFFLES, "true")


def dealt_alike(spark: SparkSession) -> AbstractContextManager[None]:
    """Tables written inside may join sides that are dealt by some of the keys as they are, without dealing them again.

    For sides whose rows of such keys fit into a task.
    """
    return _setting(spark, _ALL_KEYS, "false")


class Workspace:
    """One folder of intermediate tables below the shared folder.

    Results that read the tables are lazy, so the caller decides when to ``drop`` it.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/headway-{uuid.uuid4().hex}"
        self._tables = 0

    def save(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        self._tables += 1
        path = f"{self.folder}/{self._tables:03d}-{name}"
        with short_shuffles(df.sparkSession):
            df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def exists(self) -> bool:
        return path_exists(self.spark, self.folder)

    def drop(self) -> None:
        delete_path(self.spark, self.folder)
