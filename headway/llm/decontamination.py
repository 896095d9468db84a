"""Benchmark decontamination: one automaton over all benchmark windows, texts scanned once.

A text is normalised byte by byte (A-Z to a-z, separators to spaces, runs of spaces to one), a
window is its words with a space on either side, and an Aho-Corasick automaton over all windows
of all items finds every occurrence in one pass. Word numbers lead back to the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import spare_name
from headway.llm.words import word_spans
from headway.sources.workspace import Workspace

WINDOW_WORDS = 10

# Benchmark text in one automaton. A larger benchmark is scanned in several such blocks.
BLOCK_BYTES = 4_000_000

_SEPARATORS = frozenset([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]) - frozenset(range(0x41, 0x5B))
_NORMAL = bytes(
    0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)
)

_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RUNS = "array<struct<start:bigint,end:bigint>>"


def normal_words(text: str | None) -> list[bytes]:
    """Words of a text as lower-cased UTF-8. A null text has none."""
    return (text or "").encode().translate(_NORMAL).split()


class Windows:
    """Automaton of the windows of some items. Symbols are bytes, so UTF-8 needs no decoding."""

    def __init__(self, items: list[tuple[str, str | None]], length: int) -> None:
        owners: dict[bytes, tuple[int, list[str]]] = {}
        for item, text in items:
            words = normal_words(text)
            size = min(length, len(words))
            for i in range(len(words) - size + 1) if size else ():
                window = b" %s " % b" ".join(words[i : i + size])
                owners.setdefault(window, (size, []))[1].append(item)
        self.automaton = ahocorasick.Automaton()
        for window, (size, names) in owners.items():
            self.automaton.add_word(window.decode("latin-1"), (size, tuple(dict.fromkeys(names))))
        self.any = bool(owners)
        if self.any:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words as ``(first, end)``, and the items with a window among the words."""
        if not self.any or not words:
            return [], set()
        joined = b" %s " % b" ".join(words)
        found = list(self.automaton.iter(joined.decode("latin-1")))
        if not found:
            return [], set()
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
        ends = np.searchsorted(gaps, [end for end, _ in found])
        starts = ends - np.array([size for _, (size, _) in found])
        return merge_spans(zip(starts.tolist(), ends.tolist(), strict=True)), set(chain.from_iterable(names for _, (_, names) in found))


def merge_spans(spans) -> list[tuple[int, int]]:
    """Unite overlapping and adjoining ``(start, end)``."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def original_spans(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of the text that runs of words stand on."""
    if not words:
        return []
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), _SEPARATORS)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in words]


def _item_blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items in blocks of at most ``limit`` bytes of text, or of one larger item."""
    block, held = [], 0
    for item, text in items.orderBy("item_id", "text").toLocalIterator():
        size = len((text or "").encode())
        if block and held + size > limit:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += size
    if block:
        yield block


_built: dict[str, Windows] = {}


def _windows_of(name: str, shared, length: int) -> Windows:
    """The automaton of a broadcast block, built once per worker process."""
    if name not in _built:
        _built.clear()
        _built[name] = Windows(shared.value, length)
    return _built[name]


def _scan(docs: DataFrame, shared, length: int) -> DataFrame:
    """Add the hits of one block to ``words`` and ``items``."""
    name = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows_of(name, shared, length)
        for batch in batches:
            sizes, runs, spans, items = [], [], [], []
            for text, earlier, named in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                words = normal_words(text)
                hits, names = windows.scan(words)
                if earlier:
                    hits = merge_spans([*hits, *((run["start"], run["end"]) for run in earlier)])
                sizes.append(len(words))
                runs.append([{"start": a, "end": b} for a, b in hits])
                spans.append([{"start": a, "end": b} for a, b in original_spans(text, hits)])
                items.append(sorted(names.union(named)))
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1), pa.array(runs, _SPAN_TYPE), pa.array(items, pa.list_(pa.string())),
                    pa.array(sizes, pa.int64()), pa.array(spans, _SPAN_TYPE),
                ],
                names=["doc_id", "text", "words", "items", "n_words", "spans"],
            )

    schema = f"doc_id bigint, text string, words {_RUNS}, items array<string>, n_words bigint, spans {_RUNS}"
    return docs.select("doc_id", "text", "words", "items").mapInArrow(run, schema)


def find_contamination(
    ws: Workspace, docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc_id, text, n_words, words, spans, items)`` of every row of ``docs (doc_id, text)``.

    ``words`` are the maximal runs of word numbers inside an occurrence of a window of
    ``items (item_id, text)``; ``spans`` are their code points in the original text; ``items``
    are the ids, as sorted distinct strings, of the items with such a window.

    A null or empty text, or one of separators only, has no words and no hits; a benchmark
    item like that has no window. A null item id is the string ``null``. Repeated rows are
    scanned each by itself; repeated items name their windows once. An empty ``docs`` gives no
    rows, an empty benchmark rows without hits. Other columns of either table are not read.

    The benchmark comes to the driver and the workers in blocks of at most ``block_bytes`` (or
    one larger item). With more than one block, what a block has found is stored before the next.
    """
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    state = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.array().cast(_RUNS).alias("words"), F.array().cast("array<string>").alias("items"),
    )
    context = docs.sparkSession.sparkContext
    previous = None
    for block in _item_blocks(items, block_bytes):
        if previous is not None:
            state = ws.save(_scan(state, context.broadcast(previous), window_words), "scanned")
        previous = block
    return _scan(state, context.broadcast(previous or []), window_words)


def contamination_report(found: DataFrame) -> DataFrame:
    """Counts and a digest of the items, per row of ``find_contamination``."""
    hit = F.aggregate("words", F.lit(0).cast("bigint"), lambda total, run: total + run["end"] - run["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def drop_contaminated(ws: Workspace, docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns.

    Rows are dropped by their text: equal texts are contaminated alike.
    """
    name = spare_name(docs, "_leaked")
    texts = docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    found = find_contamination(ws, texts, items, window_words).filter(F.size("words") > 0)
    leaked = ws.save(found.select(F.md5(F.col("text").cast("binary")).alias(name)).distinct(), "contaminated")
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return docs.join(leaked, key == F.col(name), "left_anti")
