"""Language of texts by the nearest of several centroids per language.

A text is a vector of hashed byte n-grams (one to three bytes, lower case, runs of other ASCII
as a space), with logarithmic term counts and inverse document frequencies, scaled to length
one. The labelled texts of a language are clustered, each cluster's mean direction is a
centroid, and a text takes the language of the centroid of greatest cosine. A text that is far
from all of them is rejected: farther than nearly all pieces of its length of the labelled texts
are from that centroid, each measured without its own share in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.words import PIECE_BYTES, pieces
from headway.operators.skew import join_same
from headway.sources.workspace import Workspace

UNKNOWN = "und"
_BITS = 12
FEATURES = 1 << _BITS

# The classifier is fitted on about this many labelled texts of every language.
SAMPLE_PER_LANGUAGE = 400
CENTROIDS = 4

# A text whose best cosine is below this is far from every language, whatever its length.
REJECT_BELOW = 0.03

# A text is also far if its cosine is below this share of the quantile of the labelled pieces of
# its length at its nearest centroid. Of fewer pieces those of the language count, then all.
LOW_QUANTILE = 0.01
LOW_SHARE = 0.75
LEAST_PIECES = 50
# Lengths are classes of doubling numbers of different n-grams: what a text repeats says nothing new.
_CLASSES = _BITS + 1

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_FOLD = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint32)
_FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class Centroids:
    """Unit centroids, one per row of ``vectors``, with their languages, and the n-grams' weights.

    ``limits`` has the least cosine of a text per centroid and class of length.
    """

    languages: list[str]
    vectors: np.ndarray
    weights: np.ndarray
    limits: np.ndarray

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(centroid, cosine, limit)`` of every row of n-gram counts."""
        cosines = unit_vectors(counts, self.weights) @ self.vectors.T
        nearest = np.argmax(cosines, axis=1)
        return nearest, cosines.max(axis=1), self.limits[nearest, length_class(counts)]


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(np.count_nonzero(counts, axis=1), 1)).astype(int)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts of the texts, one row each."""
    texts = len(offsets) - 1
    symbols = _FOLD[data]
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    # A space after a space says nothing new.
    kept = np.ones(len(data), bool)
    kept[1:] = (symbols[1:] != 0x20) | (symbols[:-1] != 0x20) | (owner[1:] != owner[:-1])
    symbols, owner = symbols[kept], owner[kept] << _BITS
    counts = np.bincount(owner[symbols != 0x20] | symbols[symbols != 0x20], minlength=texts * FEATURES)
    gram = symbols
    for length in (2, 3):
        gram = (gram[:-1] << np.uint32(8)) | symbols[length - 1 :]
        same = owner[: 1 - length] == owner[length - 1 :]
        bucket = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BITS)
        counts += np.bincount((owner[: 1 - length] | bucket)[same], minlength=texts * FEATURES)
    return counts.reshape(texts, FEATURES)


def unit_vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts).astype(np.float32) * weights
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return vectors / np.maximum(lengths, 1e-12)[:, None]


def have_letters(texts: list[str | None], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_LETTER[data])])
    found = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in texts[i])
    return found


def cluster(vectors: np.ndarray, count: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(means, owner, lengths)``: unit mean directions of up to ``count`` clusters (far-apart first
    members, then means), the cluster of each vector, and the lengths of the clusters' sums.
    """
    means = [vectors.mean(axis=0)]
    while len(means) < min(count, len(vectors)):
        means.append(vectors[np.argmin((vectors @ np.array(means).T).max(axis=1))])
    means = np.array(means)
    for _ in range(rounds):
        _, nearest = np.unique(np.argmax(vectors @ means.T, axis=1), return_inverse=True)
        means = np.array([vectors[nearest == k].sum(axis=0) for k in range(nearest.max() + 1)])
        lengths = np.maximum(np.linalg.norm(means, axis=1), 1e-12)
        means /= lengths[:, None]
    return means, nearest, lengths


def text_pieces(text: str) -> list[str]:
    """The text, and its start, middle and end at all lengths of a power of two."""
    cut = [text]
    length = 2
    while length < len(text):
        cut += [text[at : at + length] for at in sorted({0, (len(text) - length) // 2, len(text) - length})]
        length *= 2
    return cut


def piece_cosines(text: str, unit: np.ndarray, owner: int, lengths: np.ndarray, own: int, centroids: np.ndarray, weights: np.ndarray):
    """``(centroid, class, cosine)`` of the pieces with a letter of a fitted text, at their nearest centroid.

    ``unit`` is the text's vector, ``own`` the first centroid of its language and ``lengths`` those of
    the sums. Its own cluster is taken without it; one that has no other text does not count.
    """
    centroids = centroids.copy()
    rest = centroids[own + owner] * lengths[owner] - unit
    length = np.linalg.norm(rest)
    centroids[own + owner] = rest / length if length > 1e-3 else 0
    for first, data, offsets in pieces(pa.array([t for t in text_pieces(text) if any(c.isalpha() for c in t)], pa.string()), PIECE_BYTES // 4):
        counts = term_counts(data, offsets)
        cosines = unit_vectors(counts, weights) @ centroids.T
        yield from zip(np.argmax(cosines, axis=1).tolist(), length_class(counts).tolist(), cosines.max(axis=1).tolist(), strict=True)


def length_limits(found: pd.DataFrame, languages: list[str]) -> np.ndarray:
    """Least cosines by centroid and class of ``found (centroid, class, cosine)``.

    Cosines rise with the length, so a text is held to the limit of the class below its own if that
    is less, and one longer than all pieces to that of the longest.
    """
    kind, size, cosine = (found[c].to_numpy() for c in ("centroid", "class", "cosine"))
    names = np.array(languages, object)
    limits = np.zeros((len(languages), _CLASSES))
    for k, name in enumerate(languages):
        for at in range(_CLASSES):
            groups = (cosine[(size == at) & (kind == k)], cosine[(size == at) & (names[kind] == name)], cosine[size == at])
            enough = next((g for g in groups if len(g) >= LEAST_PIECES), None)
            limits[k, at] = limits[k, max(at - 1, 0)] if enough is None else LOW_SHARE * np.quantile(enough, LOW_QUANTILE)
    return np.minimum(limits, np.concatenate([limits[:, :1], limits[:, :-1]], axis=1))


def held_out(doc_id: str = "doc_id") -> Column:
    """Every third document by the checksum of its id is kept from fitting. A null id is not."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(
    ws: Workspace, docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, count: int = CENTROIDS
) -> Centroids | None:
    """Fit on ``docs (doc_id, text, lang)``: texts with a letter and a non-null lang, not held out.

    About ``per_language`` texts of each language, by a hash of their ids, are looked at; only
    sums over a language and its centroids come to the driver. None if there is no such text.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out())
    labelled = labelled.filter(F.col("text").rlike(r"\p{L}"))
    # Drawn without the texts; those are fetched by the ids of the sample, which is small enough to be sent around.
    names = ws.save(labelled.select("doc_id", "lang"), "labelled")
    share = names.groupBy("lang").agg((F.lit(float(per_language)) / F.count(F.lit(1))).alias("_share"))
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = names.join(share, "lang").filter(draw < F.col("_share")).select("doc_id", "lang").distinct()
    sample = join_same(labelled, ws.save(drawn, "drawn"), ["doc_id", "lang"], "left_semi").select("lang", "text")

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(pc.utf8_lower(batch.column(1))):
                rows = [row.tobytes() for row in term_counts(data, offsets).astype(np.float32)]
                cut = [batch.column(c).slice(first, len(rows)) for c in (0, 1)]
                yield pa.record_batch([*cut, pa.array(rows, pa.binary())], names=["lang", "text", "counts"])

    counted = ws.save(sample.mapInArrow(count_terms, "lang string, text string, counts binary"), "language_terms")

    def matrix(group: pd.DataFrame) -> np.ndarray:
        # Rows come in no particular order; the clusters must not depend on it.
        return np.frombuffer(b"".join(sorted(group["counts"])), np.float32).reshape(-1, FEATURES)

    def frequencies(group: pd.DataFrame) -> pd.DataFrame:
        found = (matrix(group) > 0).sum(axis=0).astype(np.float64)
        return pd.DataFrame({"n": [len(group)], "found": [found.tobytes()]})

    seen = counted.groupBy("lang").applyInPandas(frequencies, "n long, found binary").collect()
    if not seen:
        return None
    texts = sum(row["n"] for row in seen)
    found = np.sum([np.frombuffer(row["found"], np.float64) for row in seen], axis=0)
    weights = np.log((1 + texts) / (1 + found)).astype(np.float32) + np.float32(1)

    def clusters(group: pd.DataFrame) -> pd.DataFrame:
        means, _, _ = cluster(unit_vectors(matrix(group), weights), count)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "vector": [m.astype(np.float32).tobytes() for m in means]})

    made = counted.groupBy("lang").applyInPandas(clusters, "lang string, vector binary").collect()
    made = sorted((row["lang"], bytes(row["vector"])) for row in made)
    vectors = np.array([np.frombuffer(vector, np.float32) for _, vector in made])
    languages = [lang for lang, _ in made]

    def distances(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["counts", "text"])
        units = unit_vectors(matrix(group), weights)
        means, owner, lengths = cluster(units, count)
        name = group["lang"].iloc[0]
        # The centroids of a language stand by their bytes.
        stand = sorted(range(len(means)), key=lambda k: means[k].astype(np.float32).tobytes())
        place = np.argsort(stand)
        found = [
            row
            for text, unit, k in zip(group["text"], units, owner, strict=True)
            for row in piece_cosines(text.lower(), unit, place[k], lengths[stand], languages.index(name), vectors, weights)
        ]
        return pd.DataFrame(found, columns=["centroid", "class", "cosine"])

    # A fixed number of texts has so many pieces at most: three a doubling of their lengths.
    near = counted.groupBy("lang").applyInPandas(distances, "centroid int, class int, cosine double").toPandas()
    return Centroids(languages, vectors, weights, length_limits(near, languages))


def predict(docs: DataFrame, centroids: Centroids | None, reject_below: float = REJECT_BELOW) -> DataFrame:
    """``(doc_id, text, lang_pred, score, rejected)`` of every row of ``docs (doc_id, text)``.

    ``score`` is the cosine to the nearest centroid. A text that is null or has no letter, or
    any text if nothing could be fitted, gets ``und`` with score 0 and is rejected; a text with
    a score below ``reject_below`` or the limit of its centroid and length is rejected and keeps
    its nearest language. Repeated rows get
    equal results, an empty table none, and other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores, far = [], [], [np.zeros(0, bool)]
            lowered = pc.utf8_lower(batch.column(1))
            for first, data, offsets in pieces(lowered):
                size = len(offsets) - 1
                known = have_letters(lowered.slice(first, size).to_pylist(), data, offsets)
                if model is None:
                    known[:] = False
                    names.extend([UNKNOWN] * size)
                    scores.append(np.zeros(size))
                    far.append(~known)
                    continue
                nearest, cosines, limits = model.nearest(term_counts(data, offsets))
                far.append(~known | (cosines < np.maximum(limits, reject_below)))
                names.extend(model.languages[k] if ok else UNKNOWN for k, ok in zip(nearest, known, strict=True))
                scores.append(np.where(known, np.clip(cosines, 0, 1), 0).astype(np.float64))
            score = np.concatenate(scores) if scores else np.zeros(0)
            rejected = np.concatenate(far)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rejected, pa.bool_())],
                names=["doc_id", "text", "lang_pred", "score", "rejected"],
            )

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return read.mapInArrow(run, "doc_id bigint, text string, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, centroids: Centroids | None, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns."""
    schema = docs.schema
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lowered = pc.utf8_lower(batch.column(place))
            kept = [np.zeros(0, bool)]
            for first, data, offsets in pieces(lowered):
                known = have_letters(lowered.slice(first, len(offsets) - 1).to_pylist(), data, offsets)
                if model is None:
                    known[:] = False
                else:
                    _, cosines, limits = model.nearest(term_counts(data, offsets))
                    known &= cosines >= np.maximum(limits, reject_below)
                kept.append(known)
            yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, schema)
