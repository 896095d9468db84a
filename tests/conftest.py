import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from headway.sources.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        # Small inputs: compiling stages costs more than it saves.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.adaptive.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="headway-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    workspace = Workspace(spark)
    yield workspace
    workspace.drop()


def adaptive(spark):
    """A session as in production: plans adapt, stages are compiled, and nothing here is small enough to broadcast."""
    session = spark.newSession()
    for key, value in (
        ("spark.sql.adaptive.enabled", "true"), ("spark.sql.codegen.wholeStage", "true"),
        ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.shuffle.partitions", "16"),
        ("spark.sql.adaptive.coalescePartitions.enabled", "false"),
    ):
        session.conf.set(key, value)
    return session


def rows(df, *columns):
    """Result rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
