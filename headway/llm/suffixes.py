"""Removal of byte strings that occurred before, by merging shards of a sparse suffix order.

Of the windows of 100 bytes, each is represented by one suffix: the one that starts at the run
of 16 bytes of least hash near the window's start (its anchor). Equal windows have equal anchors
at equal distances, so the suffixes at anchors are all that is needed. Two steps:

1. Anchors whose 16 bytes occur nowhere else are dropped.
2. Every task turns its texts into a shard of the sparse Burrows-Wheeler transform: a row per
   anchor, in suffix order, with the bytes in front of the suffix. Rows are dealt by the 16
   bytes, so all suffixes of an interval meet. There the shards' rows, each in its own order
   already, are merged: the interleave of the shards is refined eight bytes at a time, only
   inside blocks that are still equal, until every block is a single row or a repeated interval.
   The byte at which a block splits is the common prefix of its neighbours.

Windows of one anchor distance d are equal if their rows share 100 - d bytes of suffix and the d
bytes in front; the front's common lengths come from the same refinement on the reversed bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.decontamination import merge_spans
from headway.llm.tables import repeated_places, text_id, texts_of
from headway.llm.words import BYTE_VALUES, Prefix, pieces, run_starts, window_minima
from headway.sources.workspace import Workspace

WINDOW_BYTES = 100
ANCHOR_BYTES = 16


def _reach(window: int, anchor: int) -> int:
    """Places in a window at which its anchor may start."""
    return window - anchor + 1


def _anchors(data: np.ndarray, offsets: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """``(windows, texts, anchors, prefix)``: starts of all windows, their texts and anchors."""
    prefix = Prefix(BYTE_VALUES[data])
    windows, owner = run_starts(offsets, window)
    runs = np.arange(max(len(data) - anchor + 1, 0))
    picked = window_minima(prefix.hashes(runs, runs + anchor), _reach(window, anchor))
    return windows, owner, picked[windows], prefix


def _anchor_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``(hash, text_id, place)`` of the anchors of every distinct text of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, data, offsets in pieces(batch.column(1)):
                windows, owner, picked, prefix = _anchors(data, offsets, window, anchor)
                new = np.array([not (i in seen or seen.add(i)) for i in ids[first : first + len(offsets) - 1].tolist()], bool)
                at = np.unique(picked[new[owner]])
                if len(at):
                    text = np.searchsorted(offsets, at, "right") - 1
                    yield pa.record_batch(
                        [
                            pa.array(prefix.hashes(at, at + anchor).view(np.int64)), pa.array(ids[first + text]),
                            pa.array((at - offsets[text]).astype(np.int32)),
                        ],
                        names=["hash", "text_id", "place"],
                    )

    return docs.select("text_id", "text").mapInArrow(run, "hash bigint, text_id bigint, place int")


_SHARD = [
    ("hash", pa.int64()), ("shard", pa.string()), ("number", pa.int32()), ("suffix", pa.binary()), ("front", pa.binary()),
    ("no_id", pa.bool_()), ("first_id", pa.int64()), ("text_id", pa.int64()), ("place", pa.int32()), ("near", pa.int32()), ("far", pa.int32()),
]
_SHARD_SCHEMA = (
    "hash bigint, shard string, number int, suffix binary, front binary, no_id boolean, first_id bigint, text_id bigint, "
    "place int, near int, far int"
)


def _shards(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """The sparse transform of the texts of each batch: rows in suffix order, one per alive anchor.

    ``near`` and ``far`` are the least and greatest distance of a window from the anchor it has.
    Suffix and front are filled up with zeros to the longest a window can need.
    """
    reach = _reach(window, anchor)
    front_bytes = -(-(reach - 1) // 8) * 8 or 8
    suffix_bytes = -(-window // 8) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                windows, owner, picked, prefix = _anchors(data, offsets, window, anchor)
                places = batch.column(2).slice(first, len(offsets) - 1)
                alive = np.zeros(len(data) + 1, bool)
                alive[places.flatten().to_numpy() + np.repeat(offsets[:-1], np.diff(places.offsets.to_numpy()))] = True
                windows, picked = windows[alive[picked]], picked[alive[picked]]
                if not len(windows):
                    continue
                # The windows of one anchor stand side by side.
                at, begin = np.unique(picked, return_index=True)
                last = np.append(begin[1:], len(picked)) - 1
                text = np.searchsorted(offsets, at, "right") - 1
                suffix = _around(data, at, offsets[text + 1] - at, suffix_bytes, 1)
                front = _around(data, at - 1, at - offsets[text], front_bytes, -1)
                order = np.argsort(suffix.view(f"S{suffix_bytes}").ravel(), kind="stable")
                at, text, begin, last = at[order], text[order], begin[order], last[order]
                ids = [batch.column(c).take(pa.array(first + text)) for c in (3, 4, 0)]
                yield pa.record_batch(
                    [
                        pa.array(prefix.hashes(at, at + anchor).view(np.int64)),
                        pa.array([f"{batch.column(0)[first]}"] * len(at)), pa.array(np.arange(len(at), dtype=np.int32)),
                        _binary(suffix[order]), _binary(front[order]), *ids,
                        pa.array((at - offsets[text]).astype(np.int32)),
                        pa.array((at - windows[last]).astype(np.int32)), pa.array((at - windows[begin]).astype(np.int32)),
                    ],
                    schema=pa.schema(_SHARD),
                )

    return texts.select("text_id", "text", "places", "no_id", "first_id").mapInArrow(run, _SHARD_SCHEMA)


def _around(data: np.ndarray, at: np.ndarray, room: np.ndarray, count: int, step: int) -> np.ndarray:
    """``count`` bytes from each place on, forwards or backwards, zeros where the text has ended."""
    index = at[:, None] + step * np.arange(count)[None, :]
    inside = np.arange(count)[None, :] < room[:, None]
    return np.where(inside, data[np.where(inside, index, 0)], np.uint8(0))


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    kind = pa.binary(rows.shape[1])
    return pa.Array.from_buffers(kind, len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def refine_interleave(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted shards, one after the other in ``rows`` of bytes: ``(order, common)``.

    ``order`` is the interleave: which row stands where. ``common[i]`` is the number of bytes
    that the rows at i - 1 and i share. A pass looks at eight more bytes of the rows whose block
    is not settled, and splits their blocks; equal rows keep the order of the shards.
    """
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.arange(len(rows))
    starts = np.zeros(len(rows), bool)
    starts[:1] = True
    common = np.full(len(rows), rows.shape[1], np.int32)
    common[:1] = 0
    for column in range(words.shape[1]):
        alone = starts & np.append(starts[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        block = np.cumsum(starts)[open_]
        key = words[order[open_], column]
        sorted_ = np.lexsort((key, block))
        order[open_] = order[open_[sorted_]]
        key = key[sorted_]
        split = np.zeros(len(open_), bool)
        split[1:] = (block[1:] == block[:-1]) & (key[1:] != key[:-1])
        at = np.flatnonzero(split)
        starts[open_[at]] = True
        different = key[at] ^ key[at - 1]
        same = np.zeros(len(at), np.int32)
        for byte in range(1, 8):
            same += different < (np.uint64(1) << np.uint64(64 - 8 * byte))
        common[open_[at]] = 8 * column + same
    return order, common


def _intervals(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """For each row, the number of its interval of rows that share ``length`` bytes."""
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(common < length)
    return number


def _merge(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema(_SHARD))
        if not table.num_rows:
            return
        column = {name: table.column(name).combine_chunks() for name, _ in _SHARD}
        matrix = {c: np.frombuffer(b"".join(column[c].to_pylist()), np.uint8).reshape(table.num_rows, -1) for c in ("suffix", "front")}
        suffixes, fronts = refine_interleave(matrix["suffix"]), refine_interleave(matrix["front"])
        near, far = column["near"].to_numpy(), column["far"].to_numpy()
        ids, places = column["text_id"].to_numpy(), column["place"].to_numpy()
        first_id = column["first_id"].fill_null(0).to_numpy()
        earlier = np.empty(len(ids), np.int64)
        earlier[np.lexsort((places, ids, first_id, column["no_id"].to_numpy(zero_copy_only=False)))] = np.arange(len(ids))
        found = []
        for distance in range(int(near.min()), int(far.max()) + 1):
            rows = np.flatnonzero((near <= distance) & (distance <= far))
            same = _intervals(*suffixes, window - distance)[rows] * len(ids) + _intervals(*fronts, distance)[rows]
            sorted_ = np.lexsort((earlier[rows], same))
            repeated = np.zeros(len(rows), bool)
            repeated[1:] = same[sorted_[1:]] == same[sorted_[:-1]]
            rows = rows[sorted_[repeated]]
            found.append(np.stack([rows, np.full(len(rows), distance)]))
        rows, distance = np.concatenate(found, axis=1)
        # Neighbouring distances of a row are one run of bytes.
        order = np.lexsort((distance, rows))
        rows, distance = rows[order], distance[order]
        head = np.ones(len(rows), bool)
        head[1:] = (rows[1:] != rows[:-1]) | (distance[1:] != distance[:-1] + 1)
        begin = np.flatnonzero(head)
        last = np.append(begin[1:], len(rows)) - 1
        if len(begin):
            row = rows[begin]
            yield pa.record_batch(
                [
                    pa.array(ids[row]), pa.array((places[row] - distance[last]).astype(np.int64)),
                    pa.array((places[row] - distance[begin] + window).astype(np.int64)),
                ],
                names=["text_id", "start", "end"],
            )

    return run


def _cut(texts: DataFrame) -> DataFrame:
    """``(text_id, n_removed, n_spans, kept_sha256)`` of texts without their spans of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                body, kept, at = text.as_py(), [], 0
                merged = merge_spans((span["start"], span["end"]) for span in spans.as_py())
                for start, end in merged:
                    kept.append(body[at:start])
                    at = end
                kept.append(body[at:])
                rows.append((sum(b - a for a, b in merged), len(merged), sha256(b"".join(kept)).hexdigest()))
            removed, counts, digests = map(list, zip(*rows, strict=True))
            yield pa.record_batch(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests)],
                names=["text_id", "n_removed", "n_spans", "kept_sha256"],
            )

    return texts.mapInArrow(run, "text_id bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeated_bytes(
    ws: Workspace, docs: DataFrame, window: int = WINDOW_BYTES, anchor: int = ANCHOR_BYTES
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row of ``docs (doc_id, text)``.

    A byte of the UTF-8 text goes if a string of ``window`` bytes covers it that also starts
    earlier: in a document of smaller id, or earlier in the same one. Spans are maximal runs of
    such bytes. A null or empty text has no bytes; a text shorter than the window loses none. A
    null id comes after all others. Rows equal in id and text are one document listed more than
    once; of different texts of one id, the one of lesser 64-bit hash comes first. An empty table
    gives no rows. Other columns are not read.

    Anchors and texts are told apart by 64-bit hashes, windows by their bytes.
    """
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_id().alias("text_id"), "text")
    body = F.coalesce("text", F.lit(""))
    whole = ws.save(
        read.select("doc_id", "text_id", F.octet_length(body).cast("bigint").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("whole_sha256")),
        "whole_texts",
    )
    # A text's place among all texts is that of its first document; later copies go as a whole.
    firsts = whole.groupBy("text_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("first"))
    firsts = ws.save(firsts.select("text_id", "first.no_id", F.col("first.doc_id").alias("first_id")), "first_documents")
    places = repeated_places(_anchor_rows(read, window, anchor)).groupBy("text_id").agg(F.collect_set("place").alias("places"))
    texts = ws.save(texts_of(read.select("text"), ws.save(places.join(firsts, "text_id"), "anchors")), "candidates")
    dealt = _shards(texts, window, anchor).repartition("hash").sortWithinPartitions("shard", "number")
    spans = dealt.mapInArrow(_merge(window), "text_id bigint, start bigint, end bigint")
    spans = spans.groupBy("text_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    cut = ws.save(_cut(texts.select("text_id", "text").join(ws.save(spans, "spans"), "text_id")), "cut_texts")
    joined = whole.join(firsts, "text_id").join(cut, "text_id", "left")
    gone = ~F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("n_bytes") >= window)
    nothing = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", nothing)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("bigint")).otherwise(F.coalesce("n_spans", nothing)).alias("n_spans"),
        F.when(gone, F.lit(sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
