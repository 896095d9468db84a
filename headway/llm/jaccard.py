"""Exact Jaccard join of documents by their sets of word n-grams, up to connected groups.

Equal sets are one class. The n-grams of a set stand in one global order, common ones last,
and two sets that are similar enough share one of the first few (prefix filter). Those are an
index: per n-gram a list of the classes, with set size and position. Lists are used twice,
along the set relations of "Leveraging Set Relations in Exact Set Similarity Join" (VLDB 2017):

* Answers from similar sets. Every class of a list is first compared with one pivot of the
  list. Classes linked to a pivot form a group, and pairs inside a group need no answer of
  their own. For the other pairs, the overlaps with the pivot bound the overlap of the pair
  from above and below, which settles many of them without looking at the sets.
* Index skipping. What is left of a list is sorted by size and cut into blocks that know their
  sizes and best positions; a class skips whole blocks that can't hold a partner.

Only pairs that survive both are compared on their whole sets, in tasks that have the sets of the
classes of such pairs and hand on one link for every two groups they join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.graph import components
from headway.llm.tables import bit_set, document_key, spare_name, text_id, texts_of
from headway.llm.words import BYTE_VALUES, Prefix, pieces, run_starts, word_spans
from headway.operators.skew import key_fanout
from headway.sources.workspace import Workspace

SHINGLE_WORDS = 5
PERCENT = 75

# Buckets in which common n-grams are counted; one is common this much above chance.
COMMON_BUCKETS = 1 << 22
COMMON_LEAST = 8

# Bits of the bitmap of a small set, and lists of a class that tell which one a pair belongs to.
LEAST_BITMAP = 512
HEAD = 64

# Rows of a pivot's lists that one task compares with as many others, and classes of a block of them.
LIST_ROWS = 16_384
BLOCK_ROWS = 64

# Further pivots of a list, before the remaining pairs are looked at one by one.
PIVOT_ROUNDS = 2

# Index rows a task hands on at once.
ROWS_AT_ONCE = 1 << 17

# N-grams of the sets that one task compares with as many others, at about 8 bytes each, and sets it compares together.
SET_GRAMS = 1 << 20
SETS_AT_ONCE = 256

# Pairs a task looks at together, and pairs of texts it compares together.
PAIRS_AT_ONCE = 50_000
COMPARED_AT_ONCE = 2_000

_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
_LOWER_VALUES = BYTE_VALUES[_LOWER]


def shingle_sets(texts: pa.Array, words: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct hashes)`` of the n-grams of every text.

    Hashes have 63 bits. A text of fewer words has one n-gram, all of them; one without words has none.
    """
    for first, data, offsets in pieces(texts):
        starts, ends, bounds = word_spans(data, offsets)
        prefix = Prefix(Prefix(_LOWER_VALUES[data]).hashes(starts, ends))
        runs, _ = run_starts(bounds, words)
        hashes = prefix.hashes(runs, runs + words) >> np.uint64(1)
        few = np.diff(bounds)
        sizes = np.maximum(few - words + 1, 0)
        at = np.concatenate([[0], np.cumsum(sizes)])
        whole = prefix.hashes(bounds[:-1], bounds[1:]) >> np.uint64(1)
        for i in range(len(few)):
            if few[i] >= words:
                yield first + i, np.unique(hashes[at[i] : at[i + 1]])
            else:
                yield first + i, whole[i : i + 1] if few[i] else whole[:0]


def _class_of(shingles: np.ndarray) -> int:
    """A set's class: 64 bits of a digest of all its members, as a signed number."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def least_overlap(size_a, size_b, percent: int = PERCENT):
    """Least overlap of sets of these sizes that makes a link: 100 o >= percent (a + b - o)."""
    return -((-percent * (size_a + size_b)) // (100 + percent))


def prefix_length(size, percent: int = PERCENT):
    """N-grams of which a linked set must share one: all but ceil(percent size / 100), plus one."""
    if isinstance(size, Column):
        return size - F.ceil(size * percent / 100) + 1
    return size - (-((-percent * size) // 100)) + 1


def overlaps(first: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements a sorted set shares with each of some sets, none of which is empty."""
    joined = np.concatenate(others)
    place = np.minimum(np.searchsorted(first, joined), len(first) - 1)
    starts = np.concatenate([[0], np.cumsum([len(o) for o in others])[:-1]])
    return np.add.reduceat((first[place] == joined).astype(np.int64), starts)


def _bitmap(shingles: np.ndarray) -> bytes:
    """A bit for each n-gram of the set, two to four bits a member. Sets differ in at least as many n-grams
    as their bitmaps in bits, which bounds their overlap ("Bitmap Filter", Sandes et al., 2020).

    Sizes are powers of two, and a bitmap folded upon itself is that of half the size.
    """
    size = max(LEAST_BITMAP, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else LEAST_BITMAP
    bits = np.zeros(size, bool)
    bits[(shingles >> np.uint64(24)).astype(np.int64) & (size - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bitmaps: list[bytes], words: int) -> np.ndarray:
    """Bitmaps as rows of ``words`` numbers, larger ones folded."""
    out = np.zeros((len(bitmaps), words), np.uint64)
    for row, bitmap in enumerate(bitmaps):
        out[row] = np.bitwise_or.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, words), axis=0)
    return out


def _order(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The global order: common n-grams after all others. The top bit says which are common."""
    bucket = shingles & np.uint64(COMMON_BUCKETS - 1)
    flag = (common[(bucket >> np.uint64(3)).astype(np.int64)] >> (bucket & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
    return np.sort(shingles | (flag.astype(np.uint64) << np.uint64(63)))


def _sets_and_counts(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """A row per document, ``(doc_id, doc_key, digest, size, class, bitmap)``, and rows ``(bucket, n)`` of n-gram
    counts. The bitmap is given where a task meets a class first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COMMON_BUCKETS, np.uint16)
        seen: set[int] = set()
        for batch in batches:
            sizes, classes, bitmaps = [], [], []
            for _, shingles in shingle_sets(batch.column(3), words):
                name = _class_of(shingles) if len(shingles) else None
                sizes.append(len(shingles))
                classes.append(name)
                new = name is not None and name not in seen
                bitmaps.append(_bitmap(shingles) if new else None)
                if new:
                    seen.add(name)
                    bucket = (shingles[: prefix_length(len(shingles), percent)] & np.uint64(COMMON_BUCKETS - 1)).astype(np.int64)
                    counts[bucket] = np.minimum(counts[bucket], 65534) + 1
            nothing = pa.nulls(len(sizes), pa.int64())
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(bitmaps, pa.binary()), nothing, nothing],
                names=_SET_NAMES,
            )
        # A bucket that a task met once says nothing about common n-grams.
        buckets = np.flatnonzero(counts > 1)
        nothing = pa.nulls(len(buckets), pa.int64())
        yield pa.record_batch(
            [
                nothing, pa.nulls(len(buckets), pa.binary()), nothing, nothing, nothing, pa.nulls(len(buckets), pa.binary()), pa.array(buckets, pa.int64()),
                pa.array(counts[buckets].astype(np.int64)),
            ],
            names=_SET_NAMES,
        )

    read = docs.select("doc_id", document_key().alias("doc_key"), text_id().alias("digest"), "text")
    kinds = "doc_id bigint, doc_key binary, digest bigint, size bigint, class bigint, bitmap binary, bucket bigint, n bigint"
    return read.mapInArrow(run, kinds)


_SET_NAMES = ["doc_id", "doc_key", "digest", "size", "class", "bitmap", "bucket", "n"]


def _common_buckets(counted: DataFrame, percent: int) -> np.ndarray:
    """Bit set of the buckets of common n-grams: a fixed 512 KB however large the corpus is.

    It only settles the order, which may be any; links don't depend on it.
    """
    indexed = counted.filter("bucket is null").agg(F.sum(prefix_length(F.col("size"), percent))).first()[0] or 0
    mean = indexed / COMMON_BUCKETS
    limit = mean + 6 * mean**0.5 + COMMON_LEAST
    rows = counted.filter("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > limit)
    return bit_set(rows.select("bucket"), COMMON_BUCKETS)


def _index_rows(docs: DataFrame, common: np.ndarray, percent: int, words: int) -> DataFrame:
    """``(gram, class, size, place, last)``: the prefix of every set, once per class and task."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def rows_of(grams: list[np.ndarray], classes: list[int], sizes: list[int]) -> pa.RecordBatch:
        rows = np.array([len(g) for g in grams])
        first = np.concatenate([[0], np.cumsum(rows)[:-1]])
        return pa.record_batch(
            [
                pa.array(np.concatenate(grams).view(np.int64)),
                pa.array(np.repeat(np.array(classes, np.int64), rows)),
                pa.array(np.repeat(np.array(sizes, np.int32), rows)),
                pa.array((np.arange(rows.sum()) - np.repeat(first, rows)).astype(np.int32)),
                pa.array(np.repeat(np.array([g[-1] for g in grams], np.uint64).view(np.int64), rows)),
            ],
            names=["gram", "class", "size", "place", "last"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            grams, classes, sizes, held = [], [], [], 0
            for _, shingles in shingle_sets(batch.column(0), words):
                name = _class_of(shingles) if len(shingles) else None
                if name is not None and name not in seen:
                    seen.add(name)
                    # A copy, so that the rest of the set is not held with it.
                    grams.append(_order(shingles, shared.value)[: prefix_length(len(shingles), percent)].copy())
                    classes.append(name)
                    sizes.append(len(shingles))
                    held += len(grams[-1])
                    if held >= ROWS_AT_ONCE:
                        yield rows_of(grams, classes, sizes)
                        grams, classes, sizes, held = [], [], [], 0
            if grams:
                yield rows_of(grams, classes, sizes)

    return docs.select("text").mapInArrow(run, "gram bigint, class bigint, size int, place int, last bigint")


def _class_texts(docs: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """``(class, text)``: a text of each of the distinct classes."""
    wanted = sets.join(classes, "class", "left_semi").groupBy("class").agg(F.min("digest").alias("text_id"))
    return texts_of(docs, wanted).drop("text_id")


def _compare(ws: Workspace, pairs: DataFrame, docs: DataFrame, sets: DataFrame, words: int) -> DataFrame:
    """``pairs (a, b, size_a, size_b)`` of classes with their ``overlap``, counted on the whole texts."""
    classes = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    texts = _class_texts(docs, sets, classes)
    names = ["a", "b", "size_a", "size_b", "overlap"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, COMPARED_AT_ONCE):
                part = batch.slice(start, COMPARED_AT_ONCE)
                # A class that is in many pairs is cut into n-grams once.
                classes = np.concatenate([part.column(0).to_numpy(), part.column(1).to_numpy()])
                _, first, place = np.unique(classes, return_index=True, return_inverse=True)
                texts = pa.concat_arrays([part.column(2), part.column(3)]).take(pa.array(first))
                found = [shingles for _, shingles in shingle_sets(texts, words)]
                pairs = zip(place[: part.num_rows], place[part.num_rows :], strict=True)
                overlaps = [len(np.intersect1d(found[i], found[j], assume_unique=True)) for i, j in pairs]
                yield pa.record_batch([*part.columns[:2], *part.columns[4:], pa.array(overlaps, pa.int64())], names=names)

    joined = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b"
    )
    sizes = [F.col(name).cast("bigint").alias(name) for name in ("size_a", "size_b")]
    read = joined.select("a", "b", "text_a", "text_b", *sizes)
    return ws.save(read.mapInArrow(run, ", ".join(f"{name} bigint" for name in names)), "answers")


def _linked(percent: int) -> Column:
    return F.col("overlap") * 100 >= percent * (F.col("size_a") + F.col("size_b") - F.col("overlap"))


def _can_overlap(percent: int) -> Column:
    """Bound by the shared prefix: past the prefix that ends first, at most its set's rest is shared."""
    rest_a = F.col("size_a") - prefix_length(F.col("size_a"), percent)
    rest_b = F.col("size_b") - prefix_length(F.col("size_b"), percent)
    least = F.ceil(F.lit(percent) * (F.col("size_a") + F.col("size_b")) / (100 + percent))
    # Numbers with the top bit set are the common n-grams; as signed numbers they come first.
    ends_first = F.col("last_a").bitwiseXOR(F.lit(-(1 << 63))) <= F.col("last_b").bitwiseXOR(F.lit(-(1 << 63)))
    return F.col("shared") + F.when(ends_first, rest_a).otherwise(rest_b) >= least


def _star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of a class and the pivot of its list, ``(a, b, size_a, size_b)``, that may be links.

    A pair whose lists name it too seldom is left to the exact step.
    """
    a, b = F.struct("class", "size", "last"), F.struct(
        F.col("pivot").alias("class"), F.col("pivot_size").alias("size"), F.col("pivot_last").alias("last")
    )
    near = F.least("size", "pivot_size") * 100 >= percent * F.greatest("size", "pivot_size")
    stars = lists.filter("class <> pivot").filter(near)
    counted = stars.groupBy(a.alias("x"), b.alias("y")).agg(F.count(F.lit(1)).alias("shared"))
    sides = [F.col(f"{side}.{name}").alias(f"{new}_{end}") for side, end in (("x", "a"), ("y", "b")) for name, new in (("size", "size"), ("last", "last"))]
    return (
        counted.select(F.col("x.class").alias("a"), F.col("y.class").alias("b"), *sides, "shared")
        .filter(_can_overlap(percent))
        .select("a", "b", "size_a", "size_b")
    )


def _pivots(index: DataFrame, order: Column | None = None) -> DataFrame:
    """Add a pivot of the list to its rows: the first class by size, or in another order. Lists of a
    single class go."""
    ordered = Window.partitionBy("gram").orderBy("size" if order is None else order, "class")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = [F.first(c).over(whole).alias(p) for c, p in (("class", "pivot"), ("size", "pivot_size"), ("last", "pivot_last"))]
    ends = F.last("class").over(whole).alias("_end"), F.lag("class").over(ordered).alias("_before")
    # A class that several tasks met has its rows side by side here.
    return (
        index.select("*", *first, *ends)
        .filter("pivot <> _end and (_before is null or _before <> class)")
        .drop("_end", "_before")
    )


def _with_group(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Add each class's group so far, and keep lists that span several groups."""
    grouped = lists.join(groups.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "grp", F.coalesce("component", "class")
    )
    whole = Window.partitionBy("gram")
    spans = grouped.select("*", F.min("grp").over(whole).alias("_low"), F.max("grp").over(whole).alias("_high"))
    return spans.filter("_low <> _high").drop("_low", "_high", "component")


def _drawn(lists: DataFrame, groups: DataFrame, number: int) -> DataFrame:
    """The lists with a pivot drawn by this number, and only the classes outside its group."""
    drawn = _pivots(lists.select("gram", "class", "size", "place", "last"), F.xxhash64(F.lit(number), "class"))
    of_pivot = groups.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_grp"))
    of_class = groups.select(F.col("node").alias("class"), F.col("component").alias("grp"))
    apart = F.coalesce("grp", "class") != F.coalesce("pivot_grp", "pivot")
    return drawn.join(of_pivot, "pivot", "left").join(of_class, "class", "left").filter(apart)


def _in_order(gram: str) -> Column:
    """A number that orders n-grams as the sets do: those with the top bit, the common ones, come last."""
    return F.col(gram).bitwiseXOR(F.lit(-(1 << 63)))


def _merge_equal_lists(ws: Workspace, lists: DataFrame) -> DataFrame:
    """One list for all n-grams with the same classes, as from a passage that these share.

    ``grams`` says how many n-grams it stands for, of which it has the first in the global order. Lists are
    told apart by 128 bits.
    """
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "class")).alias(f"mark_{seed}") for seed in (1, 2)]
    marked = lists.groupBy("gram").agg(*marks, F.count(F.lit(1)).alias("rows"))
    kept = marked.groupBy("mark_1", "mark_2", "rows").agg(F.min_by("gram", _in_order("gram")).alias("gram"), F.count(F.lit(1)).alias("grams"))
    return ws.save(lists.join(kept.select("gram", "grams"), "gram"), "merged_lists")


def _open_pairs(lists: DataFrame, members: DataFrame, percent: int, list_rows: int) -> DataFrame:
    """``(pivot, class)``: the classes of pairs of different groups on common lists that may be linked.

    The lists of one pivot are handled together. A pivot with more than ``list_rows`` rows is cut into
    parts by class, and each two parts meet in a task of their own. ``members (class, size, grp, bitmap,
    head)`` are sent once per class, pivot and task; ``head`` has the first lists of the class. A pair belongs
    to the first list it has in common, and is left to the pivot of that one if the heads of both name it.
    """
    fanout = key_fanout(lists, ["pivot"], list_rows)
    parts = F.coalesce("fanout", F.lit(1))
    cut = lists.join(fanout, "pivot", "left").withColumn("part", F.pmod(F.xxhash64("class"), parts).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    key = ["pivot", "low", "high"]
    met = met.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    of_lists = met.select(*key, "class", "part", "gram", "place")
    once = met.groupBy(*key, "class", "part").agg(F.max("pivot_overlap").alias("pivot_overlap"))
    of_classes = once.join(members, "class").select(*key, "class", "part", "size", "grp", "pivot_overlap", "bitmap", "head")
    rows = of_classes.unionByName(of_lists, allowMissingColumns=True)
    dealt = rows.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pivot, _, _), held in _by_key(batches):
            classes = _Lists(held).open_classes(percent)
            yield pa.record_batch([pa.array(np.full(len(classes), pivot)), pa.array(classes)], names=["pivot", "class"])

    return dealt.mapInArrow(run, "pivot bigint, class bigint").distinct()


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, ...], list[pa.RecordBatch]]]:
    """The rows of each key, the first three columns, by which they are in order."""
    current, held = None, []
    for batch in batches:
        keys = [batch.column(i).to_numpy() for i in range(3)]
        changes = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), len(batch)]
        for start, end in zip(edges, edges[1:], strict=False):
            if start == end:
                continue
            if (now := tuple(int(k[start]) for k in keys)) != current:
                if held:
                    yield current, held
                current, held = now, []
            held.append(batch.slice(start, end - start))
    if held:
        yield current, held


class _Lists:
    """The lists of a pivot, or of two parts of its classes.

    A block of classes, in the order of their sizes, knows its sizes and the range of its places;
    classes that can't have a partner in it skip it. For the others, the lists that each pair shares
    are a product of two incidence matrices, and a pair stays only if its groups differ and neither
    the pivot nor the bitmaps rule it out.
    """

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches)
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        known = table.filter(pc.is_null(table["gram"])).sort_by([("size", "ascending"), ("class", "ascending")])
        self.name, part, self.size, self.group, self.pivot = (
            known[c].to_numpy() for c in ("class", "part", "size", "grp", "pivot_overlap")
        )
        self.bitmaps = known["bitmap"].to_pylist()
        heads = known["head"].combine_chunks()
        lengths = pc.list_value_length(heads).to_numpy()
        self.head = np.zeros((len(known), lengths.max(initial=0)), np.int64)
        self.named = np.arange(self.head.shape[1]) < lengths[:, None]
        self.head[self.named] = heads.flatten().to_numpy()
        listed = table.filter(pc.is_valid(table["gram"]))
        gram, place = listed["gram"].to_numpy(), listed["place"].to_numpy()
        by_name = np.argsort(self.name)
        owner = by_name[np.searchsorted(self.name[by_name], listed["class"].to_numpy())]
        order = np.argsort(owner, kind="stable")
        self.grams, numbered = np.unique(gram, return_inverse=True)
        self.lists = numbered[order]
        self.ends = np.searchsorted(owner[order], np.arange(len(self.name) + 1))
        self.low = np.minimum.reduceat(place[order], self.ends[:-1])
        self.high = np.maximum.reduceat(place[order], self.ends[:-1])
        self.same = low == high
        self.x, self.y = np.flatnonzero(part == low), np.flatnonzero(part == high)

    def _incidence(self, rows: np.ndarray) -> np.ndarray:
        counts = self.ends[rows + 1] - self.ends[rows]
        table = np.zeros((len(rows), len(self.grams)), np.float32)
        table[np.repeat(np.arange(len(rows)), counts), np.concatenate([self.lists[self.ends[k] : self.ends[k + 1]] for k in rows])] = 1
        return table

    def _differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bits in which the bitmaps of each two rows differ, at the smaller of their sizes."""
        differ = np.zeros(len(a), np.int64)
        words = np.minimum([len(self.bitmaps[k]) for k in a], [len(self.bitmaps[k]) for k in b]) // 8
        for width in np.unique(words):
            at = np.flatnonzero(words == width)
            rows, place = np.unique(np.concatenate([a[at], b[at]]), return_inverse=True)
            bits = _folded([self.bitmaps[k] for k in rows], int(width))
            step = max(1, (1 << 20) // int(width))
            for first in range(0, len(at), step):
                x, y = place[: len(at)][first : first + step], place[len(at) :][first : first + step]
                differ[at[first : first + step]] = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
        return differ

    def _belong_here(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the first common n-gram of the heads of each two rows is one of these lists, or there is none."""
        here = np.ones(len(a), bool)
        left = np.arange(len(a))
        for k in range(self.head.shape[1]):
            left = left[self.named[a[left], k]]
            if not len(left):
                break
            first, other = self.head[a[left], k], b[left]
            found = ((self.head[other] == first[:, None]) & self.named[other]).any(axis=1)
            place = np.minimum(np.searchsorted(self.grams, first), len(self.grams) - 1)
            here[left[found]] = (self.grams[place] == first)[found]
            left = left[~found]
        return here

    def open_classes(self, percent: int) -> np.ndarray:
        """The classes that may be linked with one of another group."""
        found = np.zeros(len(self.name), bool)
        if not len(self.grams) or len(self.name) < 2:
            return self.name[found]
        x, size = self.x, self.size
        for begin in range(0, len(self.y), BLOCK_ROWS):
            y = self.y[begin : begin + BLOCK_ROWS]
            # Skip the block for classes too small or too large for it, or too far off in their order.
            reach = np.minimum(self.high[x], self.high[y].max()) + np.minimum(size[x] - self.low[x], (size[y] - self.low[y]).max())
            sized = (100 * size[x] >= percent * size[y[0]]) & (size[x] * percent <= 100 * size[y[-1]])
            may = x[sized & (reach >= least_overlap(size[x], size[y[0]], percent))]
            if not len(may):
                continue
            listed = self._incidence(y)
            step = max(1, PAIRS_AT_ONCE // BLOCK_ROWS)
            for part in range(0, len(may), step):
                at = may[part : part + step]
                apart = self.group[at][:, None] != self.group[y]
                if self.same:
                    apart &= at[:, None] < y
                if not apart.any():
                    continue
                xs, ys = size[at][:, None], size[y]
                xo, yo = self.pivot[at][:, None], self.pivot[y]
                need = least_overlap(xs, ys, percent)
                # What both share with the pivot, and what each has besides it.
                bound = np.where((xo >= 0) & (yo >= 0), np.minimum(xo, yo) + np.minimum(xs - xo, ys - yo), np.minimum(xs, ys))
                near = np.minimum(xs, ys) * 100 >= percent * np.maximum(xs, ys)
                i, j = np.nonzero((self._incidence(at) @ listed.T > 0) & apart & (bound >= need) & near)
                a, b = at[i], y[j]
                likely = size[a] + size[b] - self._differing(a, b) >= 2 * need[i, j]
                a, b = a[likely], b[likely]
                here = self._belong_here(a, b) if len(a) else np.zeros(0, bool)
                found[a[here]] = found[b[here]] = True
        return self.name[found]


def _links_of_open(ws: Workspace, open_classes: DataFrame, members: DataFrame, docs: DataFrame, sets: DataFrame, percent: int, words: int, set_grams: int) -> DataFrame:
    """``(a, b)``: links that join the groups of the stored ``open_classes (pivot, class)``.

    The classes of a pivot with more than ``set_grams`` n-grams are cut into parts, and each two parts meet in a
    task of their own, with the set of each class. A task hands on at most as many links as it has classes.
    """

    def cut_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [shingles.tobytes() for _, shingles in shingle_sets(batch.column(1), words)]
            yield pa.record_batch([batch.column(0), pa.array(grams, pa.binary())], names=["class", "grams"])

    texts = _class_texts(docs, sets, open_classes.select("class").distinct()).select("class", "text")
    full = ws.save(texts.mapInArrow(cut_sets, "class bigint, grams binary"), "open_sets")
    known = open_classes.join(members.select("class", "size", "grp"), "class")
    fanout = known.groupBy("pivot").agg(F.sum("size").alias("_grams")).filter(F.col("_grams") > set_grams)
    fanout = fanout.select("pivot", F.ceil(F.col("_grams") / set_grams).cast("int").alias("fanout"))
    parts = F.coalesce("fanout", F.lit(1))
    cut = known.join(fanout, "pivot", "left").withColumn("part", F.pmod(F.xxhash64("class"), parts).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    key = ["pivot", "low", "high"]
    met = met.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    rows = met.join(full, "class").select(*key, "class", "part", "grp", "grams")
    dealt = rows.repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _by_key(batches):
            found = _Sets(held).links(percent)
            yield pa.record_batch([pa.array(list(c), pa.int64()) for c in (zip(*found, strict=True) if found else ([], []))], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


class _Sets:
    """The sets of the open classes of a pivot, or of two parts of them, in the order of their sizes."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches)
        self.one_part = table["low"][0] == table["high"][0]
        grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in table["grams"]]
        sizes, names = np.array([len(g) for g in grams]), table["class"].to_numpy()
        order = np.lexsort((names, sizes))
        self.name, self.size = names[order], sizes[order]
        self.part, self.group = table["part"].to_numpy()[order], table["grp"].to_numpy()[order]
        self.grams = [grams[k] for k in order]

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Links that join the groups of the classes, each found on the whole sets."""
        found, group, size = [], self.group.copy(), self.size
        bitmaps = [_bitmap(g) for g in self.grams]
        widths = np.array([len(b) // 8 for b in bitmaps])
        width, first, bits = 0, 0, np.zeros((0, 0), np.uint64)
        for i in range(len(size) - 1):
            last = int(np.searchsorted(size, 100 * int(size[i]) // percent, "right"))
            others = np.arange(i + 1, last)
            others = others[(group[others] != group[i]) & (self.one_part | (self.part[others] != self.part[i]))]
            if not len(others):
                continue
            # Bitmaps grow with the sets, so those that follow can be folded to this one's size.
            if widths[i] != width:
                width, first = int(widths[i]), i
                largest = int(size[np.searchsorted(widths, width, "right") - 1])
                bits = _folded(bitmaps[first : int(np.searchsorted(size, 100 * largest // percent, "right"))], width)
            differ = np.bitwise_count(bits[others - first] ^ bits[i - first]).sum(axis=1, dtype=np.int64)
            others = others[size[i] + size[others] - differ >= 2 * least_overlap(int(size[i]), size[others], percent)]
            for start in range(0, len(others), SETS_AT_ONCE):
                some = others[start : start + SETS_AT_ONCE]
                some = some[group[some] != group[i]]
                if not len(some):
                    continue
                overlap = overlaps(self.grams[i], [self.grams[j] for j in some])
                for j in some[100 * overlap >= percent * (size[i] + size[some] - overlap)]:
                    if group[j] != group[i]:
                        found.append((int(self.name[i]), int(self.name[j])))
                        group[group == group[j]] = group[i]
        return found


def _grouped_sets(ws: Workspace, docs: DataFrame, percent: int, words: int, list_rows: int, set_grams: int) -> DataFrame:
    """``(doc_id, doc_key, size, component)`` of every row; no component without n-grams."""
    counted = ws.save(_sets_and_counts(docs, percent, words), "sets")
    sets = counted.filter("bucket is null").select("doc_id", "doc_key", "digest", "size", "class", "bitmap")
    common = _common_buckets(counted, percent)
    lists = ws.save(_pivots(_index_rows(docs, common, percent, words)), "lists")

    stars = ws.save(_star_pairs(lists, percent), "star_pairs")
    answers = _compare(ws, stars, docs, sets, words)
    links = answers.filter(_linked(percent)).select("a", "b")
    groups = components(ws, links)

    # Classes outside a pivot's group are compared with other pivots, drawn for each list.
    # Large groups grow together this way, and few pairs between groups are left.
    spanning = ws.save(_with_group(lists, groups), "spanning_lists")
    if PIVOT_ROUNDS:
        done = answers.select("a", "b").unionByName(answers.select(F.col("b").alias("a"), F.col("a").alias("b")))
        more = [_star_pairs(_drawn(spanning, groups, number), percent) for number in range(1, PIVOT_ROUNDS + 1)]
        more = ws.save(reduce(DataFrame.unionByName, more).distinct().join(done, ["a", "b"], "left_anti"), "more_pairs")
        answers = answers.unionByName(_compare(ws, more, docs, sets, words))
        links = answers.filter(_linked(percent)).select("a", "b")
        groups = components(ws, links)

    known = answers.select(F.col("a").alias("class"), F.col("b").alias("pivot"), F.col("overlap").alias("_overlap"))
    left = _with_group(spanning.drop("grp"), groups).join(known, ["class", "pivot"], "left")
    overlap = F.when(F.col("class") == F.col("pivot"), F.col("size")).otherwise(F.coalesce("_overlap", F.lit(-1)))
    left = ws.save(left.withColumn("pivot_overlap", overlap.cast("int")).drop("_overlap"), "open_lists")
    classes = left.groupBy("class").agg(F.min("grp").alias("grp"), F.max("size").cast("bigint").alias("size"))
    bitmaps = sets.filter("bitmap is not null").groupBy("class").agg(F.any_value("bitmap").alias("bitmap"))
    merged = _merge_equal_lists(ws, left)
    # A class has a list at most for each n-gram of its prefix.
    heads = merged.groupBy("class").agg(F.collect_list(F.struct("place", "gram")).alias("head"))
    heads = heads.select("class", F.slice(F.transform(F.array_sort("head"), lambda g: g["gram"]), 1, HEAD).alias("head"))
    members = ws.save(classes.join(bitmaps, "class").join(heads, "class"), "open_members")
    open_classes = ws.save(_open_pairs(merged, members, percent, list_rows), "open_pairs")
    last = _links_of_open(ws, open_classes, members, docs, sets, percent, words, set_grams)
    groups = components(ws, links.unionByName(last))

    named = sets.join(groups.withColumnRenamed("node", "class"), "class", "left")
    return ws.save(named.select("doc_id", "doc_key", "size", F.coalesce("component", "class").alias("component")), "grouped_sets")


def similar_groups(
    ws: Workspace, docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS, list_rows: int = LIST_ROWS, set_grams: int = SET_GRAMS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs (doc_id, text)``.

    Two documents are linked if 100 times the size of the intersection of their n-gram sets is
    at least ``percent`` times that of the union; ``component_id`` is the least id of the
    documents reached by links, the document included. A null or empty text, or one of white
    space only, has no n-grams and no links, and its own id as component. Repeated rows are
    linked like any equal texts. A null id is never the least, so a group takes the least of its
    other ids. An empty table gives no rows. Other columns are not read.

    N-grams are known by 63-bit hashes, equal sets by 64-bit hashes.
    """
    grouped = _grouped_sets(ws, docs, percent, words, list_rows, set_grams)
    least = grouped.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("_least"))
    return grouped.join(least, "component", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("_least", "doc_id").alias("component_id")
    )


def one_of_each_group(
    ws: Workspace, docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS, list_rows: int = LIST_ROWS, set_grams: int = SET_GRAMS
) -> DataFrame:
    """The document of least id of every group of ``similar_groups``, with all columns of ``docs``.

    A null id comes after all others. A document listed in several rows equal in id and text
    stays once; of rows of one id with different texts each is a document of its own.
    """
    key, kept_key, listed = (spare_name(docs, name) for name in ("_key", "_kept_key", "_listed"))
    grouped = _grouped_sets(ws, docs, percent, words, list_rows, set_grams)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key")
    alone = F.when(F.col("component").isNull(), F.col("doc_key"))
    kept = grouped.groupBy("component", alone.alias("alone")).agg(F.min(order).alias("kept")).select(
        F.col("kept.doc_key").alias(kept_key)
    )
    kept = ws.save(kept, "kept_documents")
    once = F.row_number().over(Window.partitionBy(key).orderBy(kept_key))
    joined = docs.withColumn(key, document_key()).join(kept, F.col(key) == F.col(kept_key))
    return joined.withColumn(listed, once).filter(F.col(listed) == 1).select(*docs.columns)
