"""The trie of all prefixes of conversations, found by blocks of turns.

A conversation is cut into blocks of a few turns. A block is named by digests of all turns up to
its end, so conversations share a block if and only if they agree so far, and grouping them by the
names of their blocks gives a trie with one row per block instead of one per turn and conversation.
Only where several blocks follow the same one are their turns looked at one by one: siblings may
agree for some turns before they part. Where a single block follows, its turns have its members.

What is summed over subtrees needs no walk over the trie. A node belongs to the least conversation
that passes through it; the nodes of a conversation are the end of its path. So a sum over a
subtree is the sum over its members of all their nodes, less those its owner has above it, and
members are counted by blocks once more.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.skew import number_rows
from headway.sources.workspace import Workspace

BLOCK_TURNS = 4

# Conversations come in families of this many ids; the first one lends its turns to the others, up
# to this many less one.
FAMILY = 100
HEADS = 6

# Rows of a sorted block in which turns are numbered, and rows of one conversation summed together.
SORTED_ROWS = 200_000
CHUNK_ROWS = 4_096

# The name of a prefix is the sum of a hash of each turn and its place, as 32 bits in each of these.
_PIECES = ("p0", "p1", "p2", "p3")
_BEFORE = tuple(f"before_{piece}" for piece in _PIECES)


def _name(depth: Column, pieces: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[p.cast("string") for p in pieces]).cast("binary")))


def _root_name() -> Column:
    return _name(F.lit(0), [F.lit(0)] * len(_PIECES))


def _hash_pieces(place: str, mark: str) -> list[Column]:
    hashes = [F.xxhash64(F.lit(seed), place, mark) for seed in (1, 2)]
    return [part for h in hashes for part in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]


def running_sums(df: DataFrame, key: str, order: str, columns: tuple[str, ...], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``before_<column>``: its sum over the rows of the key with a smaller ``order``.

    ``df`` is stored; ``order`` is a whole number from 0, unique within the key. Long keys are summed
    in chunks, shifted by what the chunks before them sum to, so no task holds a whole key.
    """
    chunked = df.withColumn("_chunk", F.expr(f"{order} DIV {chunk_rows}"))
    long = chunked.filter("_chunk > 0").select(key).distinct()
    sums = chunked.join(long, key, "left_semi").groupBy(key, "_chunk").agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(key, "_chunk", *[F.sum(c).over(earlier).alias(f"_shift_{c}") for c in columns])
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    shifted = chunked.join(shifts, [key, "_chunk"], "left")
    nothing = F.lit(0).cast("bigint")
    before = [
        (F.coalesce(F.sum(c).over(inside), nothing) + F.coalesce(f"_shift_{c}", nothing)).alias(f"before_{c}") for c in columns
    ]
    return shifted.select(*df.columns, *before)


def rebuilt_turns(
    ws: Workspace, conversations: DataFrame, sorted_rows: int = SORTED_ROWS
) -> tuple[DataFrame, DataFrame]:
    """``(conv_id)`` of every conversation and its turns ``(conv_id, place, mark, chars)`` after rebuilding.

    ``mark`` is a digest of role and text, ``chars`` the code points of the text. A conversation has
    the first turns of the first one of its family, as many as the checksum of its id says, and then
    its own beyond that number.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.unhex(F.md5(said.cast("binary"))).alias("mark"),
        F.length(text).cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )
    # Equal turns are told apart by where they were read, so that no key has more rows than a block.
    numbered = ws.save(
        number_rows(ws, turns, ["conv_id"], ["turn", "mark", "row"], "place", sorted_rows).withColumns(
            {
                "first": F.col("conv_id") - F.col("conv_id") % FAMILY,
                "lent": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS,
            }
        ),
        "turns",
    )
    names = ws.save(numbered.select("conv_id", "first", "lent").distinct(), "conversations")
    heads = numbered.filter((F.col("conv_id") == F.col("first")) & (F.col("place") < HEADS)).select("first", "place", "mark", "chars")
    sizes = heads.groupBy("first").agg(F.max("place").alias("size"))
    lent = names.join(heads, "first").filter("place <= lent").select("conv_id", "place", "mark", "chars")
    own = numbered.filter("place > lent").join(sizes, "first", "left")
    moved = F.col("place") - F.col("lent") + F.least("lent", F.coalesce("size", F.lit(0)))
    return names.select("conv_id"), lent.unionByName(own.select("conv_id", moved.alias("place"), "mark", "chars"))


def _blocks(ws: Workspace, turns: DataFrame, block_turns: int) -> DataFrame:
    """A stored row per conversation and block: its own name, that of the block before it and its turns."""
    hashed = turns.withColumns(dict(zip(_PIECES, _hash_pieces("place", "mark"), strict=True)))
    hashed = hashed.withColumn("block", F.expr(f"(place - 1) DIV {block_turns}"))
    # A list has the turns of one block.
    listed = F.array_sort(F.collect_list(F.struct("place", *_PIECES, "chars"))).alias("turns")
    cut = hashed.groupBy("conv_id", "block").agg(*[F.sum(p).alias(p) for p in _PIECES], listed)
    placed = running_sums(ws.save(cut, "cut_turns"), "conv_id", "block", _PIECES)
    start = F.col("block") * block_turns
    return ws.save(
        placed.select(
            "conv_id", "block", "turns", *_BEFORE,
            _name(start, [F.col(b) for b in _BEFORE]).alias("after"),
            _name(start + F.size("turns"), [F.col(b) + F.col(p) for b, p in zip(_BEFORE, _PIECES, strict=True)]).alias("name"),
        ),
        "blocks",
    )


def _parts(ws: Workspace, blocks: DataFrame) -> DataFrame:
    """Every turn of every distinct block, as the node it ends at: ``(name, alone, n_convs, conv_id, node, parent,
    depth, chars)``. ``alone`` says that no other block follows the same one."""
    groups = ws.save(
        blocks.groupBy("name").agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
            *[F.any_value(c).alias(c) for c in ("after", "turns", *_BEFORE)],
        ),
        "block_groups",
    )
    single = groups.groupBy("after").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("n")).filter("n = 1")
    known = groups.join(single.select("name", F.lit(True).alias("alone")), "name", "left").fillna(False, ["alone"])
    turns = known.select("*", F.posexplode("turns").alias("at", "turn"))

    def upto(length: str) -> list[Column]:
        return [
            F.expr(f"{before} + aggregate(slice(turns, 1, {length}), 0L, (total, t) -> total + t.{piece})")
            for before, piece in zip(_BEFORE, _PIECES, strict=True)
        ]

    depth = F.col("turn.place")
    return ws.save(
        turns.select(
            "name", "alone", "n_convs", "conv_id", _name(depth, upto("at + 1")).alias("node"),
            _name(depth - 1, upto("at")).alias("parent"), depth.alias("depth"), F.col("turn.chars").alias("chars"),
        ),
        "parts",
    )


def _of_nodes(parts: DataFrame, keys: list[str], *sums: Column) -> DataFrame:
    """Sum over the blocks that pass through a node; a block without siblings is alone at its turns."""
    names = [c for c in parts.columns if c not in (*keys, "alone")]
    shared = parts.filter("not alone").groupBy(*keys).agg(*sums)
    return parts.filter("alone").select(*keys, *names).unionByName(shared.select(*keys, *names))


def _end_digests(ws: Workspace, ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the hash of the joined ids of the conversations that end at a node.

    Ids are joined in sorted blocks, piece by piece. A hash can only be taken in order, so the pieces
    of a node pass one task, which keeps nothing but the state of the hash.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = pa.table({"node": batch.column(0), "first": batch.column(1), "ids": batch.column(1).cast(pa.string())})
                grouped = rows.group_by("node", use_threads=False).aggregate([("first", "min"), ("ids", "list")])
                ids = pc.binary_join(grouped["ids_list"].combine_chunks(), ",")
                yield pa.record_batch(
                    [grouped["node"].combine_chunks(), grouped["first_min"].combine_chunks(), ids], names=["node", "first", "ids"]
                )

    def hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, sha256()
        for batch in batches:
            done = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if name == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = name, sha256()
                state.update(ids.encode())
            if done:
                yield pa.record_batch([pa.array(c) for c in zip(*done, strict=True)], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.record_batch([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    ranged = ws.save(ends, "ends").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ws.save(ranged.mapInArrow(join, "node binary, first bigint, ids string"), "joined_ends")
    dealt = pieces.repartition("node").sortWithinPartitions("node", "first")
    return dealt.mapInArrow(hash_in_order, "node binary, ends_sha256 string")


def prefix_trie(
    ws: Workspace, conversations: DataFrame, block_turns: int = BLOCK_TURNS, sorted_rows: int = SORTED_ROWS
) -> DataFrame:
    """The nodes of the trie of the rebuilt turns of ``conversations (conv_id, turn, role, text)``.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``: a
    node's least conversation, its depth and its parent's least conversation; the conversations that
    start with it, its children, and the childless nodes below it or at it; the code points that its
    subtree saves if every turn is kept once; the hash of the ids of the conversations that end at it.

    Turns are ordered by number, null first, and turns of one number by a digest of what they say, so
    the order of the rows does not matter; a repeated row is a turn of its own. A null role or text is
    an empty one. A row without ``conv_id`` is of no conversation. Texts are hashed whole, however
    long they are, and go no further. A conversation without turns after rebuilding ends at the root.
    An empty table has no root and gives no rows. Other columns are not read.

    Prefixes are told apart by 128 bits.
    """
    names, turns = rebuilt_turns(ws, conversations, sorted_rows)
    blocks = _blocks(ws, turns, block_turns)
    parts = _parts(ws, blocks)

    root = F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("chars")
    whole = names.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    nodes = _of_nodes(
        parts.drop("name"), ["node", "parent", "depth", "chars"],
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
    ).unionByName(whole.select(_root_name().alias("node"), *root, "n_convs", "conv_id"))
    nodes = ws.save(nodes, "nodes")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = ws.save(
        nodes.join(children, "node", "left")
        .fillna(0, ["n_children"])
        .withColumns({"saved": (F.col("n_convs") - 1) * F.col("chars"), "leaf": (F.col("n_children") == 0).cast("bigint")}),
        "valued_nodes",
    )

    sums = F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")
    owners = ws.save(nodes.groupBy("conv_id").agg(*sums).filter("saved > 0 or leaf > 0"), "owners")
    of_blocks = blocks.select("conv_id", "name").join(owners, "conv_id").groupBy("name").agg(*sums)
    weighted = parts.select("name", "alone", "node").join(of_blocks, "name").drop("name")
    below = _of_nodes(weighted, ["node"], *sums).unionByName(owners.agg(*sums).select(_root_name().alias("node"), "saved", "leaf"))
    below = below.select("node", F.col("saved").alias("saved_of_members"), F.col("leaf").alias("n_leaves"))

    last = blocks.groupBy("conv_id").agg(F.max(F.struct("block", "name")).alias("last"))
    ends = names.join(last, "conv_id", "left").select(F.coalesce("last.name", _root_name()).alias("node"), "conv_id")
    digests = _end_digests(ws, ends)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = running_sums(nodes, "conv_id", "depth", ("saved",))
    return (
        placed.join(below, "node", "left")
        .join(digests, "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
            (F.coalesce("saved_of_members", F.lit(0)) - F.col("before_saved")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
