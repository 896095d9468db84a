"""Mix sources to target weights by a low-discrepancy schedule. DataFrame functions only.

The documents of a source stand in a shuffled order and are cut into blocks of equal size, a
fixed number of them, or single words where a source has fewer. So many blocks as make up its
target are the source's slots. The mix is a row of all slots: slot i falls on the point
frac((i + 1/2) / golden ratio) of [0, 1), on which the sources' shares of the slots lie side by
side, so any stretch of the schedule holds every source nearly in proportion. The r-th slot of a
source takes its block r, and starts again at block 0 after the last one, at most
``max_repeats`` times.

Points miss a share by a few slots, so a source misses its target by a few thousandths of its own
size, or by a few words, however large the others are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.skew import join_same
from headway.sources.workspace import Workspace

WEIGHT_CYCLE = 3
MAX_REPEATS = 3

# Blocks of a source.
BLOCKS = 1024

_STEP = 0.6180339887498949
_CELLS = 4096


def count_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, 1, ... by the code points of the source names, null last."""
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    return sources.withColumn("weight", (place % WEIGHT_CYCLE + 1).cast("long"))


def share_targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target``: all words shared by ``weight``, none above ``max_repeats`` times ``source_size``.

    Sources are taken by rising limit per weight. While the level that the rest would get is
    above a source's limit, the source stays at the limit and the level rises for those after it.
    ``sources`` has one row per source, so its windows are small.
    """
    limit = F.col("source_size") * max_repeats
    order = Window.orderBy((limit / F.col("weight")).asc(), F.asc_nulls_last("source"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(earlier), F.lit(0))
    levelled = sources.withColumn("_level", left / F.sum("weight").over(rest)).withColumn(
        "_full", limit < F.col("_level") * F.col("weight")
    )
    level = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    target = F.when(F.col("_full"), limit.cast("double")).otherwise(level * F.col("weight"))
    return levelled.withColumn("target", target).drop("_level", "_full")


def cut_sources(sources: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Add ``words`` of a block, the number of ``blocks`` and that of ``slots``, which make up the target."""
    words = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(blocks))).cast("long")
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    rest = F.floor((F.col("target") - F.col("_whole") * F.col("source_size")) / F.col("words") + 0.5).cast("long")
    return (
        sources.withColumn("words", words)
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("words")).cast("long"))
        .withColumn("_whole", whole)
        .withColumn("slots", F.col("_whole") * F.col("blocks") + F.least("blocks", rest))
        .drop("_whole")
    )


def schedule(ws: Workspace, sources: DataFrame) -> DataFrame:
    """``(source, rank)`` of every slot, ``rank`` counting the slots of a source from 0.

    The points are matched to the sources' stretches by an equi-join on cells of [0, 1). A source has
    about as many of them as ``slots`` says, a bounded number.
    """
    slots = sources.agg(F.sum("slots")).first()[0] or 0
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("slots").over(order) / F.sum("slots").over(everything)
    stretches = (
        sources.filter("slots > 0")
        .withColumn("_end", end)
        .withColumn("_start", F.lag("_end", 1, 0.0).over(Window.orderBy(F.asc_nulls_last("source"))))
        # The last stretch reaches to 1, whatever the sums round to.
        .withColumn("_end", F.when(F.lead("_end").over(Window.orderBy(F.asc_nulls_last("source"))).isNull(), 2.0).otherwise(F.col("_end")))
        .withColumn("_cell", F.explode(F.sequence(
            F.floor(F.col("_start") * _CELLS), F.least(F.floor(F.col("_end") * _CELLS), F.lit(_CELLS - 1).cast("long"))
        )))
        .select("source", "_start", "_end", "_cell")
    )
    turn = (F.col("id") + 0.5) * F.lit(_STEP)
    points = ws.spark.range(slots).withColumn("_at", turn - F.floor(turn))
    points = points.withColumn("_cell", F.floor(F.col("_at") * _CELLS))
    placed = points.join(stretches, "_cell").filter("_at >= _start and _at < _end").select("id", "source")
    rank = F.row_number().over(Window.partitionBy("source").orderBy("id")) - 1
    return placed.select("source", rank.cast("long").alias("rank"))


def _stream_positions(sized: DataFrame) -> DataFrame:
    """Add ``_start``: the words of the source that stand before the document.

    Documents are shuffled by a digest of their id. The first digits of the digest cut every
    source into groups, so that no task sorts a whole source.
    """
    digest = sized.withColumn("_digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    digest = digest.withColumn("_group", F.substring("_digest", 1, 3))
    before = Window.partitionBy("source").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        digest.groupBy("source", "_group")
        .agg(F.sum("size").alias("_words"))
        .withColumn("_shift", F.coalesce(F.sum("_words").over(before), F.lit(0)))
        .drop("_words")
    )
    inside = (
        Window.partitionBy("source", "_group")
        .orderBy("_digest", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = digest.withColumn("_local", F.sum("size").over(inside) - F.col("size"))
    return join_same(local, shifts, ["source", "_group"]).select(
        "source", "doc_id", "size", (F.col("_local") + F.col("_shift")).alias("_start")
    )


def mix_sources(ws: Workspace, docs: DataFrame, max_repeats: int = MAX_REPEATS, blocks: int = BLOCKS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` of every row of ``docs (doc_id, text, source)``.

    ``size`` counts words, 0 for a null or empty text, of which nothing is taken. A null source
    is a source of its own, the last one. Repeated rows are documents of their own; of rows equal
    in id, source and size it is undefined which one stands first, and nothing else about them
    differs. A very long text spans several blocks. An empty table gives no rows. Further columns of
    ``docs`` are not looked at.

    A source's taken words differ from its target by a few blocks at most (the discrepancy of
    the points), and never exceed ``max_repeats`` times its size.
    """
    sized = ws.save(docs.select("doc_id", "source", count_words("text").alias("size")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = ws.save(cut_sources(share_targets(cycled_weights(totals), max_repeats), blocks), "sources")
    cuts = sources.select("source", "words", "blocks")
    turns = (
        join_same(schedule(ws, sources), cuts, ["source"])
        .filter(F.col("rank") < max_repeats * F.col("blocks"))
        .groupBy("source", (F.col("rank") % F.col("blocks")).alias("_block"))
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    placed = ws.save(_stream_positions(sized), "stream")
    words = F.col("words")
    first = F.floor(F.col("_start") / words)
    last = F.floor((F.col("_start") + F.col("size") - 1) / words)
    cut = join_same(placed.filter("size > 0"), cuts, ["source"]).withColumn("_block", F.explode(F.sequence(first, last)))
    inside = F.least(F.col("_start") + F.col("size"), (F.col("_block") + 1) * words) - F.greatest(
        F.col("_start"), F.col("_block") * words
    )
    taken = (
        join_same(cut, turns, ["source", "_block"])
        .groupBy("source", "doc_id", "_start", "size")
        .agg(F.sum(inside * F.col("_times")).alias("taken"))
    )
    result = join_same(placed, taken, ["source", "doc_id", "_start", "size"], "left")
    return join_same(result, sources.select("source", "source_size", "target"), ["source"]).select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
