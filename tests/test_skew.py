"""The balanced forms give what the plain forms give, with a key that holds most rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from headway.operators.skew import (
    copy_to_salts,
    history,
    key_fanout,
    number_rows,
    spread,
)
from headway.sources.workspace import list_folders


def skewed(spark):
    """600 rows, half of them under one key, one key NULL."""
    return spark.range(600).select(
        F.when(F.col("id") % 2 == 0, "hot")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 11).cast("string")))
        .alias("k"),
        (F.col("id") * 37 % 101).alias("a"),
        F.col("id").alias("b"),
        (F.col("id") * 3).alias("value"),
    )


def test_blocked_numbering_equals_the_window(spark, ws):
    df = skewed(spark)
    plain = df.withColumn(
        "position", F.row_number().over(Window.partitionBy("k").orderBy("a", "b")).cast("long")
    )
    wanted = rows(plain)
    assert rows(number_rows(ws, df, ["k"], ["a", "b"], rows_per_task=10)) == wanted
    assert rows(number_rows(ws, df, ["k"], ["a", "b"])) == wanted


def test_numbering_without_a_key_is_total(spark, ws):
    got = number_rows(ws, skewed(spark).select("b"), [], ["b"], rows_per_task=50)
    assert rows(got, "b", "position") == [(i, i + 1) for i in sorted(range(600), key=lambda i: repr((i, i + 1)))]


def test_history_across_chunks_equals_lag(spark, ws):
    df = skewed(spark)
    window = Window.partitionBy("k").orderBy("a", "b")
    lags = [F.lag("value", i).over(window).alias(f"value_{i}") for i in (1, 2, 3)]
    plain = df.select("*", F.row_number().over(window).cast("long").alias("position"), *lags)
    got = history(ws, df, ["k"], ["a", "b"], ["value"], 3, rows_per_task=20, chunk_rows=5)
    assert rows(got, *plain.columns) == rows(plain)


def test_short_series_are_not_numbered_in_blocks(spark, ws):
    """Series that fit into a chunk cost one shuffle; before, every series was stored in blocks."""
    df = ws.save(skewed(spark), "rows")
    got = history(ws, df, ["k"], ["a", "b"], ["value"], 3, rows_per_task=20, chunk_rows=300, stored=True)
    assert not any("blocks" in name for name in list_folders(spark, ws.folder))
    wanted = history(ws, df, ["k"], ["a", "b"], ["value"], 3, rows_per_task=20, chunk_rows=299, stored=True)
    assert any("blocks" in name for name in list_folders(spark, ws.folder))
    assert rows(got, *wanted.columns) == rows(wanted)


def test_numbered_rows_are_not_shuffled_again(spark, ws):
    """Blocks are numbered as they are written, so reading them has the join with their shifts only."""
    numbered = number_rows(ws, ws.save(skewed(spark), "rows"), ["k"], ["a", "b"], rows_per_task=100, stored=True)
    text = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Exchange hashpartitioning" not in text


def test_salted_join_equals_the_plain_join(spark):
    big, small = skewed(spark), spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3)], "k string, x int")
    fanout = key_fanout(big, ["k"], 50)
    assert rows(fanout.filter("k = 'hot'")) == [("hot", 6)]
    salted = spread(big, ["k"], fanout, ["b"])
    assert salted.filter("k = 'hot'").select("salt").distinct().count() == 6
    joined = salted.join(copy_to_salts(small, ["k"], fanout), ["k", "salt"]).drop("salt")
    assert rows(joined) == rows(big.join(small, "k"))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("aab"), st.integers(0, 3)), min_size=1, max_size=40))
def test_numbering_of_any_list(spark, ws, items):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(items)], "k string, v int, i int")
    got = number_rows(ws, df, ["k"], ["v", "i"], rows_per_task=4)
    wanted = []
    for key in {k for k, _ in items}:
        ordered = sorted((v, i) for i, (k, v) in enumerate(items) if k == key)
        wanted += [(key, v, i, n) for n, (v, i) in enumerate(ordered, 1)]
    assert rows(got) == sorted(wanted, key=repr)


def test_no_block_is_larger_than_a_task_should_hold(spark, ws):
    """Also with adaptive execution, which must not merge the blocks again."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        df = spark.range(20_000).select(F.lit("one").alias("k"), (F.col("id") * 7919 % 20_000).alias("a"))
        got = number_rows(ws, df, ["k"], ["a"], rows_per_task=1000)
        assert got.filter("position <> a + 1").count() == 0
        blocks = spark.read.parquet(f"{ws.folder}/{ws._tables:03d}-blocks").groupBy("_block").count()
        assert blocks.agg(F.max("count")).first()[0] <= 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "false")


def test_stored_tables_are_compressed_with_zstd(spark, ws):
    assert all(f.endswith(".zstd.parquet") for f in ws.save(spark.range(10), "numbers").inputFiles())
