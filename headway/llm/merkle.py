"""A manifest of a table of documents as a tree of hashes, with a proof for every document.

The documents of a source, in the order of their ids, are the leaves of the source's tree; the
roots of these trees, in the order of the sources, are the leaves of the tree above them. A level
is made from the one below by a pivot: nodes are grouped by their parent, conditional aggregates
put each child into the column of its slot, and the parent is the hash of these columns. A level
has a third of the rows of the one below, is stored once, and is read again on the way down, where
the columns other than a child's own are its siblings. So the way from every leaf to the root costs
one join a level over tables that shrink by the fanout, never one of all documents a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators.skew import join_same, number_rows
from headway.sources.workspace import Workspace

FANOUT = 3

# Fields of a document in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Rows of a sorted block in which nodes are numbered.
BLOCK_ROWS = 200_000

# Digests are kept as 32 bytes and hashed as hex text.
_BITS = 256


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), _BITS))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    """The hash of a document given as its ``FIELDS``."""
    return _hash(F.concat(*[_field(fields[name]) for name in FIELDS]))


def _tampered(fields: dict[str, Column]) -> Column:
    """The leaf after a text lost its line feeds, for the documents chosen by the checksum of their
    id; null for the others."""
    chosen = F.crc32(fields["doc_id"].cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, leaf_digest(fields | {"text": F.translate(fields["text"], "\n", "")}))


def _pivot(nodes: DataFrame, carried: tuple[str, ...], fanout: int) -> DataFrame:
    """The parents of ``nodes (tree, place, size, ...)``: every child's columns in those of its slot.

    ``size`` is the number of nodes of the tree on this level.
    """
    spread = [
        F.expr(f"max(CASE WHEN place % {fanout} = {slot} THEN {column} END) AS {column}_{slot}")
        for column in carried
        for slot in range(fanout)
    ]
    parents = nodes.groupBy("tree", "size", F.expr(f"place DIV {fanout} AS place")).agg(*spread)
    return parents.withColumns(
        {"digest": _hash(F.expr(f"lower(hex({_joined(range(fanout))}))")), "size": F.expr(f"(size + {fanout - 1}) DIV {fanout}")}
    )


def _joined(slots: range) -> str:
    """The digests of some slots one after the other; those of slots that are not taken are left out."""
    return f"concat({', '.join(["X''", *(f"coalesce(digest_{slot}, X'')" for slot in slots)])})"


def _levels(ws: Workspace, nodes: DataFrame, carried: tuple[str, ...], fanout: int, name: str) -> list[DataFrame]:
    """Stored levels above ``nodes``, lowest first, each with the parents of trees not yet at their root."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    levels, below = [], nodes
    while largest > 1:
        below = ws.save(_pivot(below.filter("size > 1"), carried, fanout), f"{name}_{len(levels) + 1}")
        levels.append(below)
        carried, largest = ("digest",), -(-largest // fanout)
    return levels


def _roots(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``(tree, digest)`` of the top of every tree, which may be on any level."""
    tops = [level.filter("size = 1").select("tree", "digest") for level in [nodes, *levels]]
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return roots


def _children(level: DataFrame, carried: tuple[str, ...], kept: list[str], fanout: int) -> DataFrame:
    """Every child of a level's nodes with its place, its ``carried`` columns and its way to the root.

    The way is a list of what stands before and after a node among the children of its parent: the
    columns of the slots other than its own.
    """
    children = []
    for slot in range(fanout):
        step = f"named_struct('before', {_joined(range(slot))}, 'after', {_joined(range(slot + 1, fanout))})"
        own = "".join(f"'{column}', {column}_{slot}, " for column in carried)
        child = f"named_struct('place', place * {fanout} + {slot}, {own}'way', concat(array({step}), way))"
        children.append(f"CASE WHEN digest_{slot} IS NOT NULL THEN {child} END")
    return level.select("tree", *kept, F.expr(f"explode(array_compact(array({', '.join(children)}))) AS child")).select(
        "tree", *kept, "child.*"
    )


def _ways(tops: DataFrame, nodes: DataFrame, levels: list[DataFrame], carried: tuple[str, ...], fanout: int) -> DataFrame:
    """The place, the ``carried`` columns and the ``way`` of every row of ``nodes``.

    ``tops (tree, way, ...)`` continues the way above the trees; its further columns are passed on.
    A level is joined with the ways of the nodes it has, found on the level above it.
    """
    kept = [c for c in tops.columns if c not in ("tree", "way")]
    out = ["place", *carried, *kept, "way"]
    found = None
    for depth in reversed(range(len(levels))):
        level = levels[depth]
        placed = level.filter("size = 1").join(tops, "tree")
        if found is not None:
            inside = found.select("tree", "place", *kept, "way")
            placed = placed.unionByName(level.filter("size > 1").join(inside, ["tree", "place"]))
        found = _children(placed, ("digest",) if depth else carried, kept, fanout)
    alone = nodes.filter("size = 1").join(tops, "tree").select(*out)
    return alone if found is None else alone.unionByName(found.select(*out))


def manifest(ws: Workspace, docs: DataFrame, fanout: int = FANOUT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, way, tampered)`` of every row of ``docs (doc_id, source, lang, n_chars, text)``.

    Digests are 32 bytes. ``way`` lists, from the leaf's run to the root's, the siblings before and
    after a node, one after the other; ``tampered`` is the digest of the leaf after tampering, null where there
    is none. A null field is hashed as ``-`` and so differs from an empty one; a null source is a
    source of its own, before all others; null ids come first and are never tampered with. Repeated
    rows are leaves each, side by side: rows of one id are ordered by their digests, and rows equal in
    every field have equal ones, so their order does not matter. Texts are hashed whole, however long
    they are. An empty table gives no rows. Other columns are not read.

    Only the hashes of a document are shuffled, never its text, and no task holds a source: leaves are
    numbered in sorted blocks, and a run has at most ``fanout`` rows.
    """
    fields = {name: F.col(name) for name in FIELDS}
    leaves = docs.select(
        "source", "doc_id", leaf_digest(fields).alias("digest"), _tampered(fields).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = ws.save(leaves, "leaves")
    sources = ws.save(leaves.groupBy("source").agg(F.count(F.lit(1)).alias("size")), "source_sizes")
    trees = ws.save(number_rows(ws, sources, [], ["source"], "tree", block_rows, True), "sources")
    # Equal rows are told apart by where they were read, so that no key has more rows than a block.
    numbered = number_rows(ws, leaves, ["source"], ["doc_id", "digest", "row"], "place", block_rows, True)
    named = join_same(numbered, trees, ["source"])
    carried = ("doc_id", "digest", "tampered")
    # A null id is kept as it is; the digest tells whether a slot is taken.
    nodes = ws.save(named.select("tree", (F.col("place") - 1).alias("place"), "size", *carried), "nodes")
    levels = _levels(ws, nodes, carried, fanout, "level")

    subroots = _roots(nodes, levels).withColumnRenamed("digest", "subroot")
    count = trees.agg(F.max("tree")).first()[0] or 0
    tops = ws.save(
        subroots.select(
            F.lit(0).cast("bigint").alias("tree"), (F.col("tree") - 1).alias("place"), F.lit(count).cast("bigint").alias("size"),
            F.col("subroot").alias("digest"),
        ),
        "subroots",
    )
    upper = _levels(ws, tops, ("digest",), fanout, "upper")
    top = (upper[-1] if upper else tops).select("digest").first()
    nothing = F.array().cast("array<struct<before binary, after binary>>")
    start = ws.spark.range(1).select(F.col("id").alias("tree"), nothing.alias("way"))
    of_sources = ws.save(_ways(start, tops, upper, ("digest",), fanout), "source_ways").select(
        (F.col("place") + 1).alias("tree"), F.col("digest").alias("subroot"), "way"
    )
    found = _ways(of_sources, nodes, levels, carried, fanout)
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot",
        F.lit(bytes(top["digest"]) if top else None).cast("binary").alias("root"), "way", "tampered",
    )


def fold(leaf: Column, way: Column) -> Column:
    """The root that a leaf and its siblings give, as hex text."""

    def parent(node: Column, step: Column) -> Column:
        return F.sha2(F.concat(_hex(step["before"]), node, _hex(step["after"])).cast("binary"), _BITS)

    return F.aggregate(way, _hex(leaf), parent)


def proof_report(found: DataFrame) -> DataFrame:
    """``manifest`` with its digests as hex text, the hash of all siblings, and the root folded again
    from the tampered leaf where there is one."""
    siblings = F.concat_ws("", F.transform("way", lambda step: _hex(F.concat(step["before"], step["after"]))))
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("way")))
    return folded.select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"), F.sha2(siblings.cast("binary"), _BITS).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == _hex(F.col("root"))).alias("verified"),
    )
