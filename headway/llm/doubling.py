"""Removal of word sequences that occur elsewhere, found by doubling lengths.

A window of 35 words repeats only if every shorter run in it does. So runs of 9 words are
compared first, then runs of 18 words in windows whose run of 9 repeated, then the windows
whose run of 18 did. Of the shorter runs a window is asked for one only, that of the least hash;
equal windows pick the same one, so a repeated window is never lost, and few runs are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import repeated_places, text_id, texts_of
from headway.llm.words import Prefix, pieces, run_starts, window_minima, word_hashes, word_spans
from headway.sources.workspace import Workspace

WINDOW_WORDS = 35
FIRST_WORDS = 9


def lengths(window: int = WINDOW_WORDS, first: int = FIRST_WORDS) -> list[int]:
    """Doubled from ``first`` until the window's own length ends the row."""
    row = [min(first, window)]
    while row[-1] < window:
        row.append(min(2 * row[-1], window))
    return row


def _asked_runs(prefix: Prefix, starts: np.ndarray, bounds: np.ndarray, length: int, window: int) -> np.ndarray:
    """Start of the run of ``length`` words that each window at ``starts`` is asked for."""
    if length == window:
        return starts
    runs = np.arange(max(len(prefix.sums) - length, 0))
    picked = window_minima(prefix.hashes(runs, runs + length), window - length + 1)
    return picked[starts]


def _rows_of_level(texts: DataFrame, level: int, window: int, row: list[int]) -> DataFrame:
    """``(hash, text_id, place)`` of the runs asked for at a level, by windows still alive.

    ``texts`` has ``text_id``, ``text`` and, from the second level on, the places that repeated
    at each level before, as ``level_0``, ``level_1`` and so on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, data, offsets in pieces(batch.column(1)):
                starts, ends, bounds = word_spans(data, offsets)
                prefix = Prefix(word_hashes(data, starts, ends))
                windows, owner = run_starts(bounds, window)
                for earlier in range(level):
                    asked = _asked_runs(prefix, windows, bounds, row[earlier], window)
                    places = batch.column(2 + earlier).slice(first, len(offsets) - 1)
                    alive = np.zeros(len(starts) + 1, bool)
                    counts = np.diff(places.offsets.to_numpy())
                    alive[places.flatten().to_numpy() + np.repeat(bounds[:-1], counts)] = True
                    windows, owner = windows[alive[asked]], owner[alive[asked]]
                # Equal texts are looked at once a task.
                new = np.array([not (i in seen or seen.add(i)) for i in ids[first : first + len(offsets) - 1].tolist()], bool)
                windows = windows[new[owner]]
                asked = np.unique(_asked_runs(prefix, windows, bounds, row[level], window))
                if len(asked):
                    text = np.searchsorted(bounds, asked, "right") - 1
                    yield pa.record_batch(
                        [
                            pa.array(prefix.hashes(asked, asked + row[level]).view(np.int64)),
                            pa.array(ids[first + text]), pa.array((asked - bounds[text]).astype(np.int32)),
                        ],
                        names=["hash", "text_id", "place"],
                    )

    columns = ["text_id", "text", *(f"level_{k}" for k in range(level))]
    return texts.select(*columns).mapInArrow(run, "hash bigint, text_id bigint, place int")


def _places_of(rows: DataFrame, name: str) -> DataFrame:
    """The repeated places of every text, at most as many as it has words."""
    return repeated_places(rows).groupBy("text_id").agg(F.collect_set("place").alias(name))


def repeated_windows(ws: Workspace, docs: DataFrame, window: int = WINDOW_WORDS, first: int = FIRST_WORDS) -> DataFrame:
    """``(text_id, text, places)``: the windows of each distinct text that start anywhere else too.

    ``docs`` has ``text_id`` and ``text``. Texts without a candidate leave after the first level.
    """
    row = lengths(window, first)
    alive, texts = None, docs.select("text_id", "text")
    for level in range(len(row)):
        places = ws.save(_places_of(_rows_of_level(texts, level, window, row), f"level_{level}"), f"level_{level}")
        if alive is None:
            alive = ws.save(texts_of(docs.select("text"), places), "candidates")
        elif level < len(row):
            alive = alive.join(places, "text_id")
            alive = ws.save(alive, "candidates") if level + 1 < len(row) else alive
        texts = alive
    return alive.select("text_id", "text", F.col(f"level_{len(row) - 1}").alias("places"))


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """``(text_id, n_removed, kept_sha256)`` of texts without the words their windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests = [], []
            for text, places in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                words = _words(text.as_py())
                edges = np.zeros(len(words) + 1, np.int64)
                at = np.array(places.as_py(), np.int64)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + window, -1)
                kept = np.cumsum(edges)[:-1] == 0
                removed.append(len(words) - int(kept.sum()))
                digests.append(sha256(b" ".join(w for w, k in zip(words, kept, strict=True) if k)).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(removed, pa.int64()), pa.array(digests)], names=["text_id", "n_removed", "kept_sha256"])

    return texts.mapInArrow(run, "text_id bigint, n_removed bigint, kept_sha256 string")


def _words(text: bytes | None) -> list[bytes]:
    """Words between white space of one byte each: space and the controls from tab to return."""
    return (text or b"").split()


def _whole(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_id, n_words, whole_sha256)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_words(text.as_py()) for text in batch.column(2).cast(pa.binary())]
            digests = [sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([len(w) for w in words], pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "text_id", "n_words", "whole_sha256"],
            )

    return docs.mapInArrow(run, "doc_id bigint, text_id bigint, n_words bigint, whole_sha256 string")


def without_repeated_windows(ws: Workspace, docs: DataFrame, window: int = WINDOW_WORDS, first: int = FIRST_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row of ``docs (doc_id, text)``.

    A word goes if a window of ``window`` words covers it whose words also start elsewhere, in
    another document or in the same one. A null or empty text, or one of white space only, has no
    words; a text shorter than a window loses none. Rows equal in id and text are one document
    listed more than once and don't repeat each other; equal texts of different ids do. An empty
    table gives no rows. Other columns are not read.

    Runs and texts are told apart by 64-bit hashes.
    """
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_id().alias("text_id"), "text")
    whole = ws.save(_whole(read), "whole_texts")
    id_or_none = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    copies = (
        whole.groupBy("text_id").agg(F.min(id_or_none).alias("_a"), F.max(id_or_none).alias("_b"))
        .select("text_id", (F.col("_a") != F.col("_b")).alias("_copied"))
    )
    cut = ws.save(_cut(repeated_windows(ws, read, window, first), window), "cut_texts")
    joined = whole.join(copies, "text_id").join(cut, "text_id", "left")
    gone = F.col("_copied") & (F.col("n_words") >= window)
    return joined.select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, F.lit(sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
