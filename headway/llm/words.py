"""Words, hashes and anchors of many texts at once, as whole-array work on their bytes.

A batch of texts is one byte buffer with offsets, as Arrow keeps it. Hashes are polynomials
modulo 2^64 over values drawn per byte, so the hash of any piece is a difference of two
prefix sums, times a power that makes it independent of where the piece stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACES = frozenset([0x20, *range(0x09, 0x0E)])

# Bytes of text that are handled together; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240521)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(base: int, length: int) -> np.ndarray:
    powers = np.full(length, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _powers_of(base: int, length: int) -> np.ndarray:
    room = max(1 << 16, 1 << max(0, length - 1).bit_length())
    return _powers(base, room)[:length]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of whole numbers evenly (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Prefix sums over a sequence of numbers, for the hash of any run of it."""

    def __init__(self, values: np.ndarray) -> None:
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers_of(_BASE, len(values)), out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        back = _powers_of(_INVERSE, int(starts.max()) + 1)
        return mix((self.sums[ends] - self.sums[starts]) * back[starts])


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string array into ``(first row, bytes, offsets)`` of about ``limit`` bytes. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, spaces=SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts' first words: ``(starts, ends, bounds)``; text i has words bounds[i]:bounds[i + 1]."""
    table = np.ones(256, bool)
    table[list(spaces)] = False
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Prefix(BYTE_VALUES[data]).hashes(starts, ends)


def run_starts(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``i`` with ``i : i + length`` inside one text, and that text."""
    sizes = np.maximum(np.diff(bounds) - length + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    skipped = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, int)
    return np.arange(len(owner)) - skipped[owner] + bounds[:-1][owner], owner


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least value of every window ``i : i + width``; the last one of equal values.

    What is picked depends on the window's own values only, so equal windows pick alike.
    """
    if len(values) < width:
        return np.zeros(0, np.int64)
    best, index, reach = values, np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        right = best[step:] <= best[:-step]
        index = np.where(right, index[step:], index[:-step])
        best = np.minimum(best[step:], best[:-step])
        reach += step
    return index
