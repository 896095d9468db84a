"""Personal data by fixed forms, and more of it by the contexts that the fixed forms are found in.

Emails, addresses, card and phone numbers of fixed form are seeds. The two words in front of a
value are its pattern, past punctuation that stands alone. Patterns and the values they precede
make a graph, walked in rounds. A value is found by a pattern if enough of the pattern's other
values are known to be of one kind: seeds, or values found by other patterns. Values found
bring patterns of their own in, so each round reaches a hop further. Any word may be a value,
such as ``admin@localhost`` after "write to", and so may a run of numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import TEXT_BITS, bit_set, document_key, in_bits
from headway.llm.words import mix, pieces, word_hashes, word_spans
from headway.sources.workspace import Workspace

# Kinds in their order.
KINDS = ("email", "ip", "card", "phone")

LEAST_SEEDS = 3
LEAST_SCORE = 0.8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number that fails from its first digit fails from the others too, so only those are tried.
_ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "\"'()[]{}<>,;:!?.#$%&*|"
_EDGES = np.zeros(256, bool)
_EDGES[list(_EDGE.encode())] = True

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it, after the last match, and a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def fixed_spans(text: str) -> list[Span]:
    """``(start, end, kind)`` in code points, by start and then kind."""
    spans: list[Span] = []
    if "@" in text:
        spans += [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for match in _ADDRESS.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match.group().split(".")):
                spans.append((*match.span(), "ip"))
        for match in _CARD.finditer(text):
            digits = _digits(match.group())
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                spans.append((*match.span(), "card"))
        if "+" in text:
            spans += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


Instance = tuple[str, str, str | None, int, int]


def instances(text: str, lowered: str, fixed: list[Span], wanted: Iterable[int] = ()) -> list[Instance]:
    """``(pattern, value, kind, start, end)`` of the seeds, and, without a kind, of the wanted words.

    Words are counted from 0 without those that are only punctuation. A number counts with the
    numbers that follow it. A word that a seed covers is no value of its own, and neither is a
    text's first word. ``lowered`` has the words of the text in lower case.
    """
    words, lows, spans = [], [], []
    for match, low in zip(_WORD.finditer(text), _WORD.findall(lowered), strict=True):
        word = match.group()
        core = word.strip(_EDGE)
        if core:
            left = match.start() + len(word) - len(word.lstrip(_EDGE))
            words.append(match.span())
            spans.append((left, left + len(core)))
            lows.append(low.strip(_EDGE))

    def pattern(k: int) -> str:
        return f"{lows[k - 2] if k > 1 else ''} {lows[k - 1]}"

    found: list[Instance] = []
    covered = set()
    k = 0
    for start, end, kind in fixed:
        while k < len(words) and words[k][1] <= start:
            k += 1
        if 0 < k < len(words) and words[k][0] <= start:
            found.append((pattern(k), text[start:end].lower(), kind, start, end))
        last = k
        while last < len(words) and words[last][0] < end:
            covered.add(last)
            last += 1
    for k in wanted:
        if k and k not in covered:
            last = k
            while _is_number(lows[last]) and last + 1 < len(lows) and last + 1 not in covered and _is_number(lows[last + 1]):
                last += 1
            found.append((pattern(k), " ".join(lows[k : last + 1]), None, spans[k][0], spans[last][1]))
    return found


def _is_number(core: str) -> bool:
    return bool(_DIGIT.search(core)) and not any(c.isalpha() for c in core)


def _core_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, texts, numbers)`` of the words as ``instances`` counts them."""
    starts, ends, bounds = word_spans(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    for places, step in ((starts, 1), (ends, -1)):
        at = np.arange(len(starts))
        while len(at):
            at = at[starts[at] < ends[at]]
            at = at[_EDGES[data[places[at] - (step < 0)]]]
            places[at] += step
    kept = starts < ends
    starts, ends, text = starts[kept], ends[kept], text[kept]
    return word_hashes(data, starts, ends), text, np.arange(len(text)) - np.searchsorted(text, text)


def _pattern_bits(hashes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    before = np.zeros((2, len(hashes)), np.uint64)
    before[0, 1:], before[1, 2:] = hashes[:-1], hashes[:-2]
    before[1, numbers < 2] = 0
    return _bits(mix(before[0] + before[1] * np.uint64(3)))


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 24)).astype(np.int64)


def _word_set(strings: DataFrame, of_patterns: bool) -> Broadcast:
    """Bit set of the patterns, or of the first words of the values, in a table of one column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [text.split(" ", 1) for text in batch.column(0).to_pylist()]
            hashes = []
            for word in range(1 + of_patterns):
                _, data, offsets = next(pieces(pa.array([c[word] for c in cut], pa.string()), 1 << 62), (0, np.zeros(0, np.uint8), np.zeros(1, int)))
                hashes.append(word_hashes(data, offsets[:-1], offsets[1:]))
            bits = _bits(mix(hashes[1] + hashes[0] * np.uint64(3)) if of_patterns else hashes[0])
            yield pa.record_batch([pa.array(bits)], names=["bit"])

    return strings.sparkSession.sparkContext.broadcast(bit_set(strings.mapInArrow(run, "bit bigint"), TEXT_BITS))


def _most_values(patterns: DataFrame, least_score: float) -> Broadcast:
    """By bit, how many values a pattern of ``patterns (pattern, n)`` may have to be good with its n known ones; 255 is no bound."""
    bits = patterns.mapInArrow(_numbered, "bit bigint, n bigint").groupBy("bit").agg(F.sum("n").alias("n"))
    most = np.zeros(TEXT_BITS, np.uint8)
    for row in bits.toLocalIterator():
        most[row["bit"]] = min(255, int(row["n"] / max(least_score, 1e-9)) + 2)
    return patterns.sparkSession.sparkContext.broadcast(most)


def _pattern_bit(pattern: str) -> int:
    words = [np.frombuffer(w.encode(), np.uint8) for w in pattern.split(" ", 1)]
    first, second = (word_hashes(w, np.zeros(1, int), np.array([len(w)])) for w in words)
    return int(_bits(mix(second + first * np.uint64(3)))[0])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [_pattern_bit(pattern) for pattern in batch.column(0).to_pylist()]
        yield pa.record_batch([pa.array(bits, pa.int64()), batch.column(1)], names=["bit", "n"])


def _hits(docs: DataFrame, wanted: Broadcast, of_patterns: bool, most: Broadcast | None = None) -> DataFrame:
    """``(doc_key, pattern, value, kind, start, end)``: seeds and words that may have a wanted pattern, or be a wanted value.

    A pattern that has more values in one task than ``most`` lets it have can't be good. What
    is sent on of it by then shows that, so the task leaves out the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values_of: dict[str, tuple[int, set[str]]] = {}

        def may_be_good(pattern: str, value: str) -> bool:
            if most is None:
                return True
            if pattern not in values_of:
                values_of[pattern] = (int(most.value[_pattern_bit(pattern)]), set())
            bound, values = values_of[pattern]
            if bound < 255 and len(values) <= bound:
                values.add(value)
                return bound > 0
            return bound == 255

        for batch in batches:
            lowered = pc.utf8_lower(batch.column(1))
            for first, data, offsets in pieces(lowered):
                hashes, text, numbers = _core_hashes(data, offsets)
                hit = in_bits(wanted.value, _pattern_bits(hashes, numbers) if of_patterns else _bits(hashes)) & (numbers > 0)
                rows = []
                texts, begin = np.unique(text[hit], return_index=True)
                for k, ordinals in zip(texts.tolist(), np.split(numbers[hit], begin[1:]), strict=False):
                    body = batch.column(1)[first + k].as_py()
                    found = instances(body, lowered[first + k].as_py(), fixed_spans(body), ordinals.tolist())
                    rows += [(batch.column(0)[first + k].as_py(), *row) for row in found if may_be_good(row[0], row[1])]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW, strict=True)], names=_ROW_NAMES)

    return docs.select(document_key().alias("doc_key"), "text").mapInArrow(run, _ROW_KIND)


_ROW = [pa.binary(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_ROW_NAMES = ["doc_key", "pattern", "value", "kind", "start", "end"]
_ROW_KIND = "doc_key binary, pattern string, value string, kind string, start bigint, end bigint"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
_FOUND = pa.list_(pa.struct([
    ("pattern", pa.string()), ("value", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())
]))
_SPAN_KIND = "array<struct<start:bigint,end:bigint,kind:string>>"
_FOUND_KIND = "array<struct<pattern:string,value:string,kind:string,start:bigint,end:bigint>>"


def _scan(docs: DataFrame) -> DataFrame:
    """``(doc_key, doc_id, fixed, found)`` of every row: spans of fixed form, and their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, places = [], []
            lowered = pc.utf8_lower(batch.column(2))
            for k, text in enumerate(batch.column(2)):
                text = text.as_py() or ""
                fixed = fixed_spans(text)
                spans.append([{"start": a, "end": b, "kind": kind} for a, b, kind in fixed])
                found = instances(text, lowered[k].as_py(), fixed) if fixed else []
                places.append([dict(zip(("pattern", "value", "kind", "start", "end"), c, strict=True)) for c in found])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(spans, _SPANS), pa.array(places, _FOUND)], names=["doc_key", "doc_id", "fixed", "found"]
            )

    read = docs.select(document_key().alias("doc_key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return read.mapInArrow(run, f"doc_key binary, doc_id bigint, fixed {_SPAN_KIND}, found {_FOUND_KIND}")


def _edges(found: DataFrame) -> DataFrame:
    return found.groupBy("pattern", "value").agg(F.max("kind").alias("kind"))


def found_by(edges: DataFrame, accepted: DataFrame, least_seeds: int, least_score: float) -> DataFrame:
    """``(pattern, value, of)``: the values without a fixed form that a pattern finds, of ``edges (pattern, value, kind)``.

    The pattern is judged by its other values: seeds of the kind, and values that patterns other
    than this one have found before (``accepted``, of the same columns). Numbers only are of the
    kinds that are numbers.
    """
    finders = accepted.groupBy("value", "of").agg(F.count(F.lit(1)).alias("_finders"))
    own = accepted.withColumn("_own", F.lit(1))
    learned = edges.filter("kind is null").join(finders, "value").join(own, ["pattern", "value", "of"], "left")
    learned = learned.filter(F.col("_finders") > F.coalesce("_own", F.lit(0))).select("pattern", "value", "of")
    known = edges.filter("kind is not null").select("pattern", "value", F.col("kind").alias("of")).unionByName(learned)
    support = known.groupBy("pattern", "of").agg(F.count(F.lit(1)).alias("_known")).filter(F.col("_known") >= least_seeds)
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("_values"))
    judged = edges.filter("kind is null").select("pattern", "value").join(support.join(sizes, "pattern"), "pattern")
    judged = judged.join(learned.withColumn("_self", F.lit(1)), ["pattern", "value", "of"], "left")
    others = F.col("_known") - F.coalesce("_self", F.lit(0))
    shaped = (F.col("of") == "email") | F.col("value").rlike("[0-9]")
    good = judged.filter((others >= least_seeds) & (others >= least_score * (F.col("_values") - 1)) & shaped)
    return good.select("pattern", "value", "of")


def find_identifiers(
    ws: Workspace, docs: DataFrame, least_seeds: int = LEAST_SEEDS, least_score: float = LEAST_SCORE
) -> DataFrame:
    """``(doc_id, fixed, added)`` of every row of ``docs (doc_id, text)``: spans ``(start, end, kind)``
    in code points, of fixed form and found by context.

    A null or empty text has none. Repeated rows get equal spans, but their values count once in
    the graph. Added spans lie outside the fixed ones. An empty table gives no rows. Other
    columns are not read.

    A round reads the texts for the patterns of what is known, and for all values of those
    patterns; bit sets of fixed size let only words pass that may be wanted. What is known only
    grows from round to round, and rounds end when nothing new is found, so a value is found however
    many patterns away from the fixed forms it stands. Texts are read whole, however long they are.
    """
    scanned = ws.save(_scan(docs), "scanned")
    seeds = ws.save(_edges(scanned.select(F.explode("found").alias("f")).select("f.*")), "seed_edges")
    accepted = docs.sparkSession.createDataFrame([], "pattern string, value string, of string")
    known, total = seeds.select("pattern", "value", F.col("kind").alias("of")), 0
    for number in count():
        if number:
            values = accepted.select("value", "of").distinct()
            places = _hits(docs, _word_set(values.select("value"), False), False).filter("kind is null").select("pattern", "value").distinct()
            known = seeds.select("pattern", "value", F.col("kind").alias("of")).unionByName(places.join(values, "value").select("pattern", "value", "of"))
        patterns = known.groupBy("pattern", "of").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_seeds)
        patterns = ws.save(patterns.groupBy("pattern").agg(F.max("n").alias("n")), f"patterns_{number}")
        near = _hits(docs, _word_set(patterns.select("pattern"), True), True, _most_values(patterns, least_score))
        found = ws.save(near.join(patterns, "pattern", "left_semi"), f"found_{number}")
        accepted = ws.save(found_by(ws.save(_edges(found), f"edges_{number}"), accepted, least_seeds, least_score), f"accepted_{number}")
        before, total = total, accepted.count()
        if total == before:
            break
    nothing = F.array().cast(_SPAN_KIND)
    # One kind an edge: the first.
    kinds = accepted.groupBy("pattern", "value").agg(F.min(_rank("of")).alias("rank"))
    kinds = kinds.select("pattern", "value", F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("rank") + 1).alias("of"))
    new = found.filter("kind is null").join(kinds, ["pattern", "value"]).groupBy("doc_key").agg(
        F.collect_set(F.struct("start", "end", F.col("of").alias("kind"))).alias("added")
    )
    return scanned.join(new, "doc_key", "left").select("doc_id", "fixed", F.coalesce("added", nothing).alias("added"))


def _rank(kind: str):
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col(kind)).cast("int") - 1


def _written(spans):
    """Spans as ``kind:start:end`` by start, then kind as listed."""
    rank = lambda span: F.array_position(F.array(*[F.lit(k) for k in KINDS]), span["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def identifier_report(found: DataFrame) -> DataFrame:
    """Counts and a digest of the fixed spans and a list of all, per row of ``find_identifiers``."""
    kinds = F.col("fixed.kind")
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "doc_id", *counts,
        F.sha2(_written(F.col("fixed")).cast("binary"), 256).alias("base_sha256"),
        _written(F.concat("fixed", "added")).alias("spans"),
    )
