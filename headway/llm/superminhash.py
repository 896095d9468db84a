"""Near-duplicate documents by SuperMinHash signatures, bands, exact checks and union-find.

A signature ("SuperMinHash", Ertl 2017) gives every element of a set a random permutation of the
slots and, for the j-th slot of that order, the rank j plus a random fraction; a slot holds the least
rank that came to it. The ranks of one element are spread over the slots evenly, which makes the
share of equal slots vary less than with independent hashes, and an element whose next rank is
above every slot's has nothing more to say, which ends most elements after a few draws.

Sets that agree in all slots of a band are candidates. Bands are never spread into pairs: in each
round the least class of a bucket is compared with those of its bucket that are not in its group
yet, on the full sets, and leaves the bucket. After a few rounds nearly all that belongs together
is one group; classes of several groups that are still in one bucket are compared inside tasks, by
their signatures and, where those say that a link is possible, on the full sets. A task hands on no
more links than it takes to join its groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.graph import components
from headway.llm.jaccard import overlaps, shingle_sets
from headway.llm.tables import text_id, texts_of
from headway.llm.words import mix
from headway.operators.skew import key_fanout
from headway.sources.workspace import Workspace

SHINGLE_WORDS = 3
PERCENT = 85

# Two sets of similarity 0.85 agree in at least one of these bands but for 3 cases in 10 million.
BANDS = 48
BAND_SLOTS = 8
SLOTS = BANDS * BAND_SLOTS

# Rounds with a pivot per bucket before the rest is compared inside tasks.
ROUNDS = 3

# Classes whose equal slots fall short of the wanted similarity by more than this are not compared
# on their sets: five standard deviations of independent slots, and these vary less.
MARGIN = 0.10

# Rows of a bucket that one task compares with as many others of it, and rows compared at once.
BUCKET_ROWS = 1024
BLOCK_ROWS = 128

# Elements whose permutations are kept at once; a small set counts as this many.
CHUNK_ELEMENTS = 1 << 15
LEAST_ELEMENTS = 16

_ALL_BITS = (1 << 64) - 1
_EMPTY = np.uint64(_ALL_BITS)
_STEP = 0x9E3779B97F4A7C15
_FRACTION_BITS = np.uint64(40)
_FRACTION = np.uint64((1 << 40) - 1)


def signatures(elements: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """The signatures of sets given one after the other; an empty set has only empty slots.

    A slot is the rank (high bits) and the fraction (low 40 bits). All elements draw their j-th slot
    together; a set whose slots are all taken has ranks up to j only and is done.
    """
    table = np.full(len(sizes) * slots, _EMPTY, np.uint64)
    missing = np.full(len(sizes), slots)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order, rows = np.zeros((0, slots), np.uint16), None
    for j in range(slots):
        if not len(elements):
            break
        draw = mix(elements + np.uint64((j + 1) * _STEP & _ALL_BITS))
        chosen = j + (((draw >> _FRACTION_BITS) * np.uint64(slots - j)) >> np.uint64(24)).astype(np.int64)
        if rows is None:
            slot = chosen
        else:
            # The j-th place of the permutation gets what stood at a place drawn from the rest.
            slot = order[rows, chosen].astype(np.int64)
            order[rows, chosen] = order[rows, j]
        value = (np.uint64(j) << _FRACTION_BITS) | (draw & _FRACTION)
        place = owner * slots + slot
        taken = np.unique(place[table[place] == _EMPTY])
        np.minimum.at(table, place, value)
        missing -= np.bincount(taken // slots, minlength=len(sizes))
        left = missing[owner] > 0
        if rows is None:
            elements, owner, chosen = elements[left], owner[left], chosen[left]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
            rows = np.arange(len(elements))
            order[rows, chosen] = 0
        elif not left.all():
            elements, owner, rows = elements[left], owner[left], rows[left]
    return table.reshape(-1, slots)


def band_hashes(table: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A hash of every band of every signature, with the number of the band."""
    parts = table.reshape(len(table), bands, -1)
    hashes = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_STEP), parts.shape[:2])
    for slot in range(parts.shape[2]):
        hashes = mix(hashes ^ parts[:, :, slot])
    return hashes.view(np.int64)


def _chunks(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Sets of similar size together, since small ones need many draws and large ones few."""
    by_size = np.argsort(sizes, kind="stable")
    ends = np.cumsum(np.maximum(sizes[by_size], LEAST_ELEMENTS))
    first = 0
    while first < len(by_size):
        start = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, start + CHUNK_ELEMENTS, "right")), first + 1)
        yield by_size[first:last]
        first = last


def _class_of(shingles: np.ndarray) -> int:
    """A set's class: 64 bits of a digest of all its elements, as a signed number."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, digest, size, class, bands, sketch)`` of every row.

    A class is all sets with the same elements; ``bands`` and the ``sketch``, a byte of every slot, are
    given where a task meets a class first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, classes, new, sets = [], [], [], []
            for row, shingles in shingle_sets(batch.column(2), words):
                name = _class_of(shingles) if len(shingles) else None
                sizes.append(len(shingles))
                classes.append(name)
                if name is not None and name not in seen:
                    seen.add(name)
                    new.append(row)
                    sets.append(shingles)
            counts = np.array([len(s) for s in sets], np.int64)
            bands = np.zeros((len(sets), BANDS), np.int64)
            sketches = np.zeros((len(sets), SLOTS), np.uint8)
            for chunk in _chunks(counts):
                table = signatures(np.concatenate([sets[i] for i in chunk]), counts[chunk])
                bands[chunk] = band_hashes(table)
                sketches[chunk] = table.astype(np.uint8)
            lengths = np.zeros(batch.num_rows, np.int32)
            lengths[new] = BANDS
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            given: list[bytes | None] = [None] * batch.num_rows
            for row, sketch in zip(new, sketches, strict=True):
                given[row] = sketch.tobytes()
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1))), pa.array(given, pa.binary()),
                ],
                names=["doc_id", "digest", "size", "class", "bands", "sketch"],
            )

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_id().alias("digest"), "text")
    return read.mapInArrow(run, "doc_id bigint, digest bigint, size bigint, class bigint, bands array<bigint>, sketch binary")


def _crowded(sets: DataFrame) -> DataFrame:
    """``(band, bucket, class, size)`` of the buckets with several classes."""
    rows = sets.select(F.posexplode("bands").alias("band", "bucket"), "class", "size")
    several = rows.groupBy("bucket").agg(F.min("class").alias("_a"), F.max("class").alias("_b")).filter("_a <> _b")
    return rows.join(several.select("bucket"), "bucket").distinct()


def _full_sets(docs: DataFrame, sets: DataFrame, crowded: DataFrame, words: int) -> DataFrame:
    """``(class, elements)``: the sorted elements of every class that is in a crowded bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            elements = [shingles.tobytes() for _, shingles in shingle_sets(batch.column(1), words)]
            yield pa.record_batch([batch.column(0), pa.array(elements, pa.binary())], names=["class", "elements"])

    wanted = sets.join(crowded.select("class").distinct(), "class", "left_semi").groupBy("class")
    texts = texts_of(docs, wanted.agg(F.min("digest").alias("text_id")))
    return texts.select("class", "text").mapInArrow(run, "class bigint, elements binary")


def _links(ws: Workspace, pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The stored pairs ``(a, b)`` whose sets are similar enough, less those that a task has joined already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            while (above := parent.get(node, node)) != node:
                parent[node] = node = parent.get(above, above)
            return node

        for batch in batches:
            found, held, second = [], None, None
            for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if root(a) == root(b):
                    continue
                if b != held:
                    held, second = b, np.frombuffer(y.as_buffer(), np.uint64)
                first = np.frombuffer(x.as_buffer(), np.uint64)
                overlap = len(np.intersect1d(first, second, assume_unique=True))
                if 100 * overlap >= percent * (len(first) + len(second) - overlap):
                    parent[root(a)] = root(b)
                    found.append((a, b))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    a, b = (full.select(F.col("class").alias(side), F.col("elements").alias(f"elements_{side}")) for side in "ab")
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "elements_a", "elements_b")
    return ws.save(joined.mapInArrow(run, "a bigint, b bigint"), "links")


def _labelled(rows: DataFrame, labels: DataFrame | None, column: str, label: str) -> DataFrame:
    """Add the group of a class, which is its own while it has no other."""
    if labels is None:
        return rows.withColumn(label, F.col(column))
    named = labels.select(F.col("class").alias(column), F.col("component").alias("_component"))
    return rows.join(named, column, "left").withColumn(label, F.coalesce("_component", column)).drop("_component")


def _merge_groups(ws: Workspace, labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The groups ``(class, component)`` after further links, found among the groups so far only."""
    ends = _labelled(_labelled(links, labels, "a", "_a"), labels, "b", "_b")
    found = components(ws, ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    if labels is None:
        return found.withColumnRenamed("node", "class")
    moved = labels.join(found.select(F.col("node").alias("component"), F.col("component").alias("_new")), "component", "left")
    added = found.select(F.col("node").alias("class"), "component").join(labels, "class", "left_anti")
    return ws.save(moved.select("class", F.coalesce("_new", "component").alias("component")).unionByName(added), "groups")


def _several_groups(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of the buckets whose classes are in several groups, with their group as ``grp``."""
    grouped = _labelled(rows, labels, "class", "grp")
    mixed = grouped.groupBy("bucket").agg(F.min("grp").alias("_a"), F.max("grp").alias("_b")).filter("_a <> _b")
    return grouped.join(mixed.select("bucket"), "bucket")


class _Block:
    """Some rows of a bucket, ordered by size: two parts of it, or one that is compared with itself."""

    def __init__(self, rows: list[tuple], low: int, high: int) -> None:
        part, band, name, size, group, sketch, elements = zip(*sorted(rows, key=lambda r: (r[3], r[2])), strict=True)
        self.band, self.name, self.group, self.elements = band[0], np.array(name), group, elements
        self.size = np.array(size)
        self.sketch = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(rows), SLOTS)
        self.same = low == high
        self.x, self.y = np.flatnonzero(np.array(part) == low), np.flatnonzero(np.array(part) == high)

    def candidates(self, percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(row, other rows)`` that the sketches allow to be linked and that met in no earlier band."""
        least = (percent / 100 - MARGIN) * SLOTS
        group = np.array(self.group)
        for first in range(0, len(self.x), BLOCK_ROWS):
            rows = self.x[first : first + BLOCK_ROWS]
            sizes = self.size[self.y]
            low = np.searchsorted(sizes, -(-percent * self.size[rows[0]] // 100))
            high = np.searchsorted(sizes, 100 * self.size[rows[-1]] // percent, "right")
            for second in range(low, high, BLOCK_ROWS):
                others = self.y[second : min(second + BLOCK_ROWS, high)]
                apart = group[rows][:, None] != group[others]
                if self.same:
                    apart &= rows[:, None] < others
                if not apart.any():
                    continue
                a, b = self.sketch[rows][:, None, :], self.sketch[others][None, :, :]
                equal = a == b
                shared = equal.reshape(*equal.shape[:2], BANDS, BAND_SLOTS).all(axis=3)
                met_here = shared.argmax(axis=2) == self.band
                near = apart & met_here & (np.count_nonzero(equal, axis=2) >= least)
                for i in np.flatnonzero(near.any(axis=1)):
                    yield int(rows[i]), others[near[i]]

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Links that join the groups of the rows, each found on the full sets."""
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            while (above := parent.get(node, node)) != node:
                parent[node] = node = parent.get(above, above)
            return node

        found = []
        for row, others in self.candidates(percent):
            others = [j for j in others.tolist() if root(self.group[j]) != root(self.group[row])]
            if not others:
                continue
            first = np.frombuffer(self.elements[row], np.uint64)
            overlap = overlaps(first, [np.frombuffer(self.elements[j], np.uint64) for j in others])
            linked = 100 * overlap >= percent * (self.size[row] + self.size[others] - overlap)
            for j in np.array(others)[linked].tolist():
                if root(self.group[j]) != root(self.group[row]):
                    parent[root(self.group[j])] = root(self.group[row])
                    found.append((int(self.name[row]), int(self.name[j])))
        return found


def _links_in_buckets(rows: DataFrame, members: DataFrame, percent: int, bucket_rows: int) -> DataFrame:
    """``(a, b)``: links between the groups of ``rows (band, bucket, class, size, grp)``.

    A bucket of more than ``bucket_rows`` rows is cut into parts, and each two parts meet in a task of
    their own. Two classes are compared in the first band they share: if they aren't both in that
    bucket any more, one of them was compared with the other, or they are in one group. Each row gets
    its class's ``members (class, sketch, elements)`` once, after the buckets are counted and cut.
    """
    fanout = key_fanout(rows, ["bucket"], bucket_rows)
    parts = F.coalesce("fanout", F.lit(1))
    cut = rows.join(fanout, "bucket", "left").join(members, "class")
    cut = cut.withColumn("part", F.pmod(F.xxhash64("class"), parts).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    key = ["bucket", "low", "high"]
    columns = [*key, "part", "band", "class", "size", "grp", "sketch", "elements"]
    dealt = met.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).select(*columns)
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links_of(key: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            found = _Block(held, *key[1:]).links(percent) if len(held) > 1 else []
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

        key, held = None, []
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if row[:3] != key:
                    if held:
                        yield from links_of(key, held)
                    key, held = row[:3], []
                held.append(row[3:])
        if held:
            yield from links_of(key, held)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _groups(ws: Workspace, docs: DataFrame, sets: DataFrame, percent: int, words: int, rounds: int, bucket_rows: int) -> DataFrame | None:
    """``(class, component)`` of the classes that are linked with another one."""
    crowded = ws.save(_crowded(sets), "crowded_buckets")
    full = ws.save(_full_sets(docs, sets, crowded, words), "full_sets")
    labels = None
    left = crowded.withColumn("grp", F.col("class"))
    for _ in range(rounds):
        first = left.groupBy("bucket").agg(
            F.min("class").alias("b"), F.min_by("size", "class").alias("size_b"), F.min_by("grp", "class").alias("grp_b")
        )
        met = left.join(first, "bucket").filter(F.col("class") != F.col("b"))
        near = F.least("size", "size_b") * 100 >= percent * F.greatest("size", "size_b")
        pairs = met.filter(F.col("grp") != F.col("grp_b")).filter(near).select(F.col("class").alias("a"), "b").distinct()
        links = _links(ws, ws.save(pairs, "pivot_pairs"), full, percent)
        if not links.isEmpty():
            labels = _merge_groups(ws, labels, links)
        left = ws.save(_several_groups(met.select("band", "bucket", "class", "size"), labels), "crowded_buckets")
        if left.isEmpty():
            return labels
    wanted = left.select("class").distinct()
    sketches = sets.filter("sketch is not null").join(wanted, "class", "left_semi")
    sketches = sketches.groupBy("class").agg(F.any_value("sketch").alias("sketch"))
    members = ws.save(full.join(sketches, "class"), "members")
    links = ws.save(_links_in_buckets(left, members, percent, bucket_rows), "links")
    return labels if links.isEmpty() else _merge_groups(ws, labels, links)


def near_duplicates(
    ws: Workspace, docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS, rounds: int = ROUNDS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``docs (doc_id, text)``.

    Documents are linked if 100 times the size of the intersection of their sets of ``words``-word
    shingles is at least ``percent`` times that of the union, counted on the full sets; ``component_id``
    is the least id of the documents reached by links, the document included, and ``kept`` says that it
    is the document's own. A null or empty text, or one of white space only, has no shingles and no
    links; a shorter one has all its words as one. Rows with the same set are one class, so copies and
    repeated rows are linked and none of them is compared. A null id is never the least while the group
    has others, and is kept only where it has none. Whole texts are read, however long they are. An
    empty table gives no rows. Other columns are not read.

    Shingles are known by 63-bit hashes, equal sets by 64-bit hashes. Bands miss a link of the least
    similarity in 3 of 10 million cases; a component mostly has other links as well.
    """
    sets = ws.save(_sets(docs, words), "sets")
    labels = _groups(ws, docs, sets, percent, words, rounds, bucket_rows)
    rows = sets.select("doc_id", "size", "class")
    grouped = ws.save(_labelled(rows, labels, "class", "component"), "grouped_documents")
    least = grouped.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("_least"))
    return grouped.join(least, "component", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("_least", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("_least", "doc_id")).alias("kept"),
    )
