"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.sources.workspace import Workspace

# Links that a task puts together at once.
LINKS_PER_TASK = 1 << 17


def _local_stars(links: DataFrame, links_per_task: int, with_roots: bool) -> DataFrame:
    """Links ``(a, b)``, ``a > b``, as stars: each task hooks its nodes to the least one it can reach by links of its own.

    The least ones are hooked to themselves if they are asked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(node):
            while (above := parent.get(node, node)) != node:
                parent[node] = node = parent.get(above, above)
            return node

        def stars() -> pa.RecordBatch:
            nodes = list(parent)
            if with_roots:
                nodes += {root(node) for node in nodes}
            return pa.record_batch([pa.array(nodes, pa.int64()), pa.array([root(node) for node in nodes], pa.int64())], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) >= links_per_task:
                yield stars()
                parent.clear()
        if parent:
            yield stars()

    return links.mapInArrow(run, "a bigint, b bigint")


def _are_stars(links: DataFrame) -> bool:
    """Whether every node of ``links (a, b)``, ``a > b``, is either a centre or has one link, to a centre."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    of_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return of_node.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(ws: Workspace, edges: DataFrame, links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """Stored ``(node, component)`` of every node of ``edges (a, b)``, whole numbers; the component is its least node.

    Tasks of about ``links_per_task`` links make stars of what they see. The stars of several tasks are joined by
    large-star and small-star rounds (Kiveris et al., 2014): every node hooks its neighbours to
    the least of them. Neighbours are only aggregated and joined, never gathered, and each round
    is stored, so a lost executor costs one round.
    """
    links = ws.save(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    tasks = -(-links.count() // links_per_task)
    alone = tasks <= 1
    links = ws.save(_local_stars(links.coalesce(max(1, tasks)), links_per_task, alone), "local_stars")
    if alone:
        return links.withColumnsRenamed({"a": "node", "b": "component"})
    while not _are_stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = ws.save(large.filter("a <> b").distinct(), "large_star")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(least, "a")
        small = moved.select("b", "least").filter("b <> least").unionByName(
            moved.select(F.col("a").alias("b"), "least")
        )
        links = ws.save(small.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "small_star")
    roots = links.select(F.col("b").alias("node")).distinct()
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ws.save(nodes.unionByName(roots.select("node", F.col("node").alias("component"))), "components")
