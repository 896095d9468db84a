"""Fingerprints of texts from phrases that a locally consistent parsing finds in them.

Bytes are parsed into blocks, blocks into blocks of blocks, and so on. Runs of one symbol are
taken as one. Then deterministic coin tossing gives every symbol a label from its own bits and
those of its left neighbour, again and again until there are six labels and neighbours still
differ; blocks start at labels greater than both neighbours'. Where a block starts depends on a
few symbols around it, so equal substrings have equal phrases inside, wherever they stand. The
phrases' names of the higher levels are the text's signature, and the least of them a sketch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.words import BYTE_VALUES, mix, pieces
from headway.sources.workspace import Workspace

# Phrases of these levels, of about 20 and 50 bytes, make the signature.
LEVELS = (3, 4)
SKETCH = 64

# Bytes of text in one range of ids, and the most ranges.
RANGE_BYTES = 4_000_000
MAX_RANGES = 10_000


def _toss(previous: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which the two differ, plus the symbol's bit there."""
    different = previous ^ symbol
    place = np.bitwise_count((different & -different) - different.dtype.type(1))
    place = np.minimum(place, 8 * different.itemsize - 1).astype(different.dtype)
    return (2 * place + ((symbol >> place) & different.dtype.type(1))).astype(np.uint8)


def _table(size: int) -> np.ndarray:
    previous, symbol = (a.ravel().astype(np.uint8) for a in np.mgrid[0:size, 0:size])
    return _toss(previous, symbol)


_TOSS_BYTES, _TOSS_LABELS = _table(256), _table(128)


def _left(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Left neighbours; the first symbol of a text has 0."""
    left = np.empty_like(values)
    left[1:] = values[:-1]
    left[first] = 0
    return left


def parse(names: np.ndarray, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the names of the blocks of symbols, and where each text's blocks start.

    ``symbols`` are what coins are tossed on: bytes at the lowest level, else the names.
    """
    # Runs of one symbol become one, named by symbol and length.
    starts = np.ones(len(names), bool)
    starts[1:] = names[1:] != names[:-1]
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    at = np.flatnonzero(starts)
    runs = np.diff(np.append(at, len(names)))
    names, symbols = names[at], symbols[at]
    names = np.where(runs > 1, mix(names + runs.astype(np.uint64)), names)
    if symbols.dtype != np.uint8:
        symbols = names
    bounds = np.searchsorted(at, bounds)
    if not len(names):
        return names, bounds
    first = bounds[:-1][np.diff(bounds) > 0]

    left = _left(symbols, first)
    if symbols.dtype == np.uint8:
        labels = _TOSS_BYTES[left.astype(np.uint16) << np.uint16(8) | symbols]
    else:
        labels = _toss(left, symbols)
    for _ in range(3):
        labels = _TOSS_LABELS[_left(labels, first).astype(np.uint16) << np.uint16(7) | labels]
    right = np.zeros(len(labels), np.int8)
    right[:-1] = labels[1:]
    right[np.append(first[1:], len(labels)) - 1] = -1
    heads = (labels > _left(labels, first)) & (labels.astype(np.int8) > right)
    heads[first] = True
    at = np.flatnonzero(heads)
    place = np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))
    blocks = mix(np.add.reduceat(mix(names + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), at))
    return blocks, np.searchsorted(at, bounds)


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The ``SKETCH`` least distinct signature names of every text, 32 bits each, in order."""
    found: list[np.ndarray] = []
    for _, data, offsets in pieces(pa.array(texts, pa.large_string())):
        names, bounds, symbols = BYTE_VALUES[data], offsets, data
        signature = []
        for level in range(1, max(LEVELS) + 1):
            names, bounds = parse(names, symbols, bounds)
            symbols = names
            if level in LEVELS:
                signature.append((mix(names + np.uint64(level)) >> np.uint64(32), bounds))
        for i in range(len(offsets) - 1):
            own = np.unique(np.concatenate([n[b[i] : b[i + 1]] for n, b in signature]))
            found.append(own[:SKETCH].astype(np.uint32))
    return found


def write_sketch(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the least names of both together that both have: an estimate of the signatures'
    Jaccard similarity, exact for short texts. Two empty sketches are alike."""
    least = np.union1d(a, b)[:SKETCH]
    if not len(least):
        return 1.0
    return float((np.isin(least, a) & np.isin(least, b)).mean())


def _edges(docs: DataFrame) -> np.ndarray:
    """Ids that cut the documents into ranges of about equal numbers; as many as the bytes need."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MAX_RANGES, -(-size // RANGE_BYTES))
    if ranges < 2:
        return np.zeros(0, np.int64)
    cuts = docs.filter("doc_id is not null").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges)
    return np.unique(np.array(cuts, np.int64))


def with_next_text(ws: Workspace, docs: DataFrame) -> DataFrame:
    """``(range, tail, doc_id, digest, text)``: documents by ranges of descending id, each range
    followed, as its ``tail``, by the first document of the next one.

    Only the ranges' first ids pass through the driver, as many as there are ranges.
    """
    edges = docs.sparkSession.sparkContext.broadcast(_edges(docs))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        # Descending: the greatest ids are range 0, documents without id the last one.
        cuts = edges.value
        place = len(cuts) - np.searchsorted(cuts, ids.fillna(0).astype("int64").to_numpy(), "right")
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, place)).astype("int32")

    placed = docs.withColumn("digest", F.xxhash64("text")).withColumn("range", range_of("doc_id"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), (-F.col("doc_id")).alias("down"), "digest")
    heads = placed.groupBy("range").agg(F.min(order).alias("head")).orderBy("range").collect()
    before = {row["range"]: heads[i - 1]["range"] for i, row in enumerate(heads)}
    follows = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else None
    if follows is None:
        return placed.select("range", F.lit(False).alias("tail"), "doc_id", "digest", "text")
    firsts = docs.sparkSession.createDataFrame(
        [(row["range"], row["head"]["down"], row["head"]["digest"]) for row in heads], "range int, down bigint, digest bigint"
    )
    firsts = firsts.select("range", "digest", (-F.col("down")).alias("_id"), F.lit(True).alias("_head"))
    marked = placed.join(
        F.broadcast(firsts), (placed["range"] == firsts["range"]) & (placed["digest"] == firsts["digest"]) & placed["doc_id"].eqNullSafe(firsts["_id"]), "left"
    ).select(placed["range"], placed["doc_id"], placed["digest"], placed["text"], "_head")
    here = F.struct(F.col("range"), F.lit(False).alias("tail"))
    there = F.struct(F.element_at(follows, F.col("range")).alias("range"), F.lit(True).alias("tail"))
    spots = F.explode(F.when(F.col("_head"), F.array(here, there)).otherwise(F.array(here)))
    return marked.withColumn("spot", spots).select("spot.range", "spot.tail", "doc_id", "digest", "text")


def edited_text(text: str, following: str) -> str:
    """The last half of the text gives way to as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]


def fingerprints(ws: Workspace, docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next)``, a row
    per document of ``docs (doc_id, text)``.

    ``edited`` is the text with its last half replaced by the start of the next document's, in
    descending order of ids; a null id comes last, and equal ids by the text's 64-bit hash. After
    the last document comes the first; one document alone follows itself. A null text is an empty
    one, and all empty texts have the empty fingerprint. Repeated rows are documents of their
    own. An empty table gives no rows. Other columns are not read.
    """
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    laid = with_next_text(ws, read).repartition("range").sortWithinPartitions("range", "tail", F.desc_nulls_last("doc_id"), "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last document seen waits for the one after it.
        waiting: tuple | None = None
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ranges, tails, ids, texts = (part.column(i).to_pylist() for i in range(4))
                own = sketches(texts)
                pairs = []
                for row in zip(ranges, tails, ids, texts, own, strict=True):
                    if waiting is not None and waiting[0] == row[0] and not waiting[1]:
                        pairs.append((waiting, row))
                    waiting = row
                edited = [edited_text(a[3], b[3]) for a, b in pairs]
                rows = [
                    (a[2], len(a[3]), text, write_sketch(a[4]), write_sketch(new), likeness(a[4], new), likeness(a[4], b[4]))
                    for (a, b), text, new in zip(pairs, edited, sketches(edited) if edited else [], strict=True)
                ]
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(_OUT)
                yield pa.record_batch([pa.array(list(c), t) for c, (_, t) in zip(columns, _OUT, strict=True)], names=[n for n, _ in _OUT])

    kinds = "doc_id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return laid.select("range", "tail", "doc_id", "text").mapInArrow(run, kinds)
