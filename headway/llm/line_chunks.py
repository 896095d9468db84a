"""Removal of repeated runs of lines.

A piece of two or more lines that has occurred before, byte for byte, is removed; the first
occurrence (by document id, then place) stays. Ways to cut a text into pieces:

- ``line_pairs``: any two neighbouring lines. Every run of two or more lines that occurred before
  is made of such pairs, so it goes whole, whatever stands around it.
- ``cut_chunks``: a hash rolls over the hashes of the last ``ROLL_LINES`` lines, and a chunk ends
  where it is divisible by ``DIVISOR``. Lines put in front of a passage shift nothing: the same
  lines end the same chunks again. The lines of a run before its first boundary and after its
  last one stay, and so do chunks of one line.
- ``chunks_and_pairs``: the chunks, and the pairs for what these cannot see.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.tables import TEXT_BITS, bit_set, document_key, in_bits, key_bit, key_bits, spare_name
from headway.llm.words import BYTE_VALUES, Prefix, mix
from headway.sources.workspace import Workspace

ROLL_LINES = 2
DIVISOR = 3
LEAST_LINES = 2

# Bytes of the digest that names a piece.
KEY_BYTES = 16

# Bytes of pieces that are handed on together.
PART_BYTES = 1 << 24


def cut_chunks(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, lines)`` of the chunks of a text, ends before the chunk's last line break.

    An empty text has no lines and no chunks.
    """
    if not text:
        return []
    data = np.frombuffer(text, np.uint8)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.concatenate([breaks, [len(data)]])
    rolled = lines = Prefix(BYTE_VALUES[data]).hashes(starts, ends)
    for back in range(1, ROLL_LINES):
        rolled = rolled.copy()
        rolled[back:] = mix(rolled[back:] + lines[:-back] * np.uint64(2 * back + 1))
    last = rolled % np.uint64(DIVISOR) == 0
    last[: ROLL_LINES - 1] = False
    last[-1] = True
    stops = np.flatnonzero(last) + 1
    firsts = np.concatenate([[0], stops[:-1]])
    return [(int(starts[a]), int(ends[b - 1]), int(b - a)) for a, b in zip(firsts, stops, strict=True)]


def line_pairs(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, 2)`` of any two neighbouring lines of a text, as ``cut_chunks`` has its chunks."""
    if not text:
        return []
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A)
    starts = np.concatenate([[0], breaks + 1]).tolist()
    ends = np.append(breaks, len(text)).tolist()
    return [(a, b, 2) for a, b in zip(starts, ends[1:], strict=False)]


def chunks_and_pairs(text: bytes) -> list[tuple[int, int, int]]:
    """The chunks of ``cut_chunks`` and the pairs of ``line_pairs``.

    A chunk of two lines is a pair already; as a piece of its own it would seem to repeat it.
    """
    return [chunk for chunk in cut_chunks(text) if chunk[2] > 2] + line_pairs(text)


Cut = Callable[[bytes], list[tuple[int, int, int]]]


def _without(body: bytes, pieces: list[tuple[int, int, int]]) -> tuple[bytes, int]:
    """The text without the lines of the pieces, and how many lines they have."""
    lines = body.split(b"\n")
    breaks = np.flatnonzero(np.frombuffer(body, np.uint8) == 0x0A)
    gone = set()
    for first, (_, _, count) in zip(np.searchsorted(breaks, [start for start, _, _ in pieces]).tolist(), pieces, strict=True):
        gone.update(range(first, first + count))
    return b"\n".join(line for k, line in enumerate(lines) if k not in gone), len(gone)


_CHUNKS = "doc_key binary, place struct<no_id:boolean,doc_id:bigint,doc_key:binary,chunk:int>, chunk_key binary"
_PLACE = pa.struct([("no_id", pa.bool_()), ("doc_id", pa.int64()), ("doc_key", pa.binary()), ("chunk", pa.int32())])


def _key_set(keys: DataFrame, key: str) -> Broadcast:
    """A bit set of fixed size that holds all keys: one outside it is surely not among them."""
    return keys.sparkSession.sparkContext.broadcast(bit_set(keys.select(key_bit(key).alias("bit")), TEXT_BITS))


def _chunk_rows(
    docs: DataFrame, cut: Cut, key_bytes: int, exact: frozenset[bytes] = frozenset(), wanted: Broadcast | None = None, body: bool = False
) -> DataFrame:
    """One row per piece of at least ``LEAST_LINES`` lines, if its key may be wanted; with its ``body`` if asked for.

    A piece is named by a digest of its bytes, or by the bytes themselves if the digest is in ``exact``.
    """


    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if wanted is None else wanted.value
        rows: tuple[list, ...] = ([], [], [], [])
        held = 0

        def made() -> pa.RecordBatch:
            kinds = (pa.binary(), _PLACE, pa.binary(), pa.binary())[: 3 + body]
            return pa.record_batch([pa.array(r, k) for r, k in zip(rows, kinds, strict=False)], names=["doc_key", "place", "chunk_key", "body"][: 3 + body])

        for batch in batches:
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()))
            for key, doc_id, text in zip(columns[0], columns[1], columns[2], strict=True):
                whole = text.as_py() or b""
                for number, (start, end, lines) in enumerate(cut(whole)):
                    if lines < LEAST_LINES:
                        continue
                    chunk = whole[start:end]
                    name = xxhash.xxh3_128_digest(chunk)[:key_bytes]
                    name = chunk + name if name in exact else name
                    bit = int.from_bytes(name[:3], "big")
                    if bits is not None and not bits[bit >> 3] >> (bit & 7) & 1:
                        continue
                    place = {"no_id": doc_id is None, "doc_id": doc_id, "doc_key": key, "chunk": number}
                    for values, value in zip(rows, (key, place, name, chunk if body else None), strict=True):
                        values.append(value)
                    held += 100 + len(name) + len(chunk) * body
                    if held > PART_BYTES:
                        yield made()
                        rows, held = ([], [], [], []), 0
        if rows[0]:
            yield made()

    read = docs.select(document_key().alias("doc_key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return read.mapInArrow(run, _CHUNKS + ", body binary" * body)


def repeated_chunks(ws: Workspace, docs: DataFrame, cut: Cut, key_bytes: int) -> DataFrame:
    """``(doc_key, chunks)``: the numbers of the pieces to remove, for documents that have some.

    Only digests are gathered first, combined before the shuffle. Of each digest that has several
    places the least and the greatest bytes are taken, combined before the shuffle too; where
    they differ, its pieces are named by their bytes instead. A bit set keeps most other pieces
    from being shuffled.
    """

    def first_places(exact: frozenset[bytes], name: str) -> DataFrame:
        places = _chunk_rows(docs, cut, key_bytes, exact).groupBy("chunk_key")
        places = places.agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first <> last")
        return ws.save(places.select("chunk_key", "first"), name)

    exact: frozenset[bytes] = frozenset()
    places = first_places(exact, "chunk_keys")
    wanted = _key_set(places, "chunk_key")
    bodies = _chunk_rows(docs, cut, key_bytes, wanted=wanted, body=True).groupBy("chunk_key")
    clashing = bodies.agg(F.min("body").alias("least"), F.max("body").alias("most")).filter("least <> most").select("chunk_key")
    exact = frozenset(bytes(row["chunk_key"]) for row in clashing.collect())
    if exact:
        places = first_places(exact, "exact_keys")
        wanted = _key_set(places, "chunk_key")
    return (
        _chunk_rows(docs, cut, key_bytes, exact, wanted)
        .join(places, "chunk_key")
        .filter("place <> first")
        .groupBy("doc_key")
        .agg(F.collect_set("place.chunk").alias("chunks"))
    )


def without_repeats(ws: Workspace, docs: DataFrame, cut: Cut = cut_chunks, key_bytes: int = KEY_BYTES) -> DataFrame:
    """``docs`` with all its columns, ``text`` without repeated pieces of ``cut``, and two columns more at the
    end: ``_lines`` before and ``_lines_removed``, or longer names where those are taken.

    ``docs`` needs ``doc_id`` and ``text``. The lines that stay are joined by line breaks. A
    null text stays null and an empty one empty, without lines. A null id comes after all
    others. Rows equal in id and text are one document listed more than once, so they don't
    repeat each other and lose the same lines; rows of one id with other texts are documents of
    their own. An empty table gives none.
    """
    dead = ws.save(repeated_chunks(ws, docs, cut, key_bytes), "dead_chunks")
    key, dead_key, chunks, bit = (spare_name(docs, name) for name in ("_key", "_dead_key", "_chunks", "_bit"))
    keyed = docs.withColumn(key, document_key())
    dead_keys = _key_set(dead, "doc_key")

    @F.pandas_udf("boolean")
    def may_lose(bits: pd.Series) -> pd.Series:
        return pd.Series(in_bits(dead_keys.value, bits.to_numpy()))

    # Only documents that may lose lines are shuffled; the bit set says so for each key alike.
    joined = keyed.withColumn(bit, key_bit(key)).filter(may_lose(bit)).drop(bit).join(
        dead.select(F.col("doc_key").alias(dead_key), F.col("chunks").alias(chunks)), F.col(key) == F.col(dead_key), "left"
    )
    counts = [spare_name(docs, name) for name in ("_lines", "_lines_removed")]
    place, kept = docs.columns.index("text"), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, removed = [], [], []
            dead_of = batch.column(kept + 2).to_pylist()
            for text, dead in zip(batch.column(place).cast(pa.binary()), dead_of, strict=True):
                body = text.as_py()
                lines.append(body.count(b"\n") + 1 if body else 0)
                gone = 0
                if dead:
                    chunks = cut(body)
                    body, gone = _without(body, [chunks[k] for k in dead])
                removed.append(gone)
                texts.append(body)
            arrays = batch.columns[:kept]
            arrays[place] = pc.cast(pa.array(texts, pa.binary()), pa.string())
            names = [*batch.schema.names[:kept], *counts]
            yield pa.record_batch([*arrays, pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], names=names)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~in_bits(dead_keys.value, key_bits(batch.column(kept)))))
            breaks = pc.fill_null(pc.count_substring(batch.column(place), "\n"), 0).to_numpy(zero_copy_only=False)
            filled = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False) > 0
            lines = pa.array(np.where(filled, breaks + 1, 0).astype(np.int64))
            names = [*batch.schema.names[:kept], *counts]
            yield pa.record_batch([*batch.columns[:kept], lines, pa.array(np.zeros(len(batch), np.int64))], names=names)

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in counts)])
    return keyed.mapInArrow(untouched, schema).union(joined.mapInArrow(run, schema))


def line_report(cleaned: DataFrame) -> DataFrame:
    """Counts and a digest of the text that is left, per row of ``without_repeats``."""
    lines, removed = cleaned.columns[-2:]
    return cleaned.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col(lines).alias("n_lines"),
        F.col(removed).alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
