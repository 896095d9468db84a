"""The prefix trie, the hash tree and SuperMinHash against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from headway.llm import merkle, superminhash, tries

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def counted(df):
    return Counter(tuple(row) for row in df.collect())


# --- prefix trie --------------------------------------------------------------------

CONVERSATIONS = "conv_id long, turn long, role string, text string, place int, name string, node string"


def talks(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", "x") for r in rows], CONVERSATIONS).repartition(3)


def said_digest(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), said_digest(role, text), (role or "", text or "")))
    original = {c: [t[2] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = original.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(key[:-1] for key in members if key)
    leaves, saved = Counter(), Counter()
    for key, convs in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(convs) - 1) * len(key[-1][1]) if key else 0
    return Counter(
        (
            min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), children[key], leaves[key], saved[key],
            sha(",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(key))),
        )
        for key, convs in members.items()
    )


@pytest.fixture(scope="module")
def conversations():
    """Families that share beginnings, copies, ties, nulls, one very long conversation and one long text."""
    rng = random.Random(5)
    said = [("user", "hé llo"), ("assistant", "a"), ("user", ""), (None, "b"), ("user", None), ("a", "1:b")]
    rows = []
    for c in [*range(0, 40), *range(95, 130), 250, 251, 399, -3, -205, 10**12 + 7]:
        turns = rng.choices(said, k=rng.randint(1, 11))
        rows += [(c, rng.choice([t, t, None, 3]), *turn) for t, turn in enumerate(turns)]
    common = [(t, *said[t % 3]) for t in range(9)]
    rows += [(c, *turn) for c in range(500, 560) for turn in common]
    rows += [(700, t, "user", f"t{t // 2}") for t in range(150)] + [(701, t, "user", f"t{t // 2}") for t in range(120)]
    rows += [(800, 0, "user", "é" * 1_000_000), (801, 0, "user", "é" * 1_000_000), (None, 1, "user", "none's")]
    return rows + rows[:3] + rows[:1]


@pytest.mark.parametrize("block_turns, sorted_rows", [(4, 200_000), (1, 40), (7, 40)])
def test_prefix_trie(spark, ws, conversations, monkeypatch, block_turns, sorted_rows):
    monkeypatch.setattr(tries.running_sums, "__defaults__", (5,))
    assert counted(tries.prefix_trie(ws, talks(spark, conversations), block_turns, sorted_rows)) == brute_trie(conversations)


def test_small_tries(spark, ws):
    assert tries.prefix_trie(ws, talks(spark, [])).count() == 0
    assert tries.prefix_trie(ws, talks(spark, [(None, 1, "user", "x")])).count() == 0
    # Conversation 1 borrows turns of conversation 0, which is not there, and has none of its own left.
    lonely = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(lonely, 1, "user", "x")]
    assert counted(tries.prefix_trie(ws, talks(spark, rows))) == brute_trie(rows) == Counter([(lonely, 0, None, 1, 0, 1, 0, sha(str(lonely)))])


# --- hash tree ----------------------------------------------------------------------

DOCUMENTS = "doc_id long, source string, lang string, n_chars long, text string, tree int, place string, digest string, way int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "d", 2) for r in rows], DOCUMENTS).repartition(3)


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return sha("".join(field(v) for v in row))


def climb(leaves, fanout):
    """The root of some leaves and for each its way of (siblings before, siblings after)."""
    ways, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place // fanout * fanout
            ways[i].append((level[run:place], level[place + 1 : run + fanout]))
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        at = [place // fanout for place in at]
    return level[0], ways


def brute_manifest(rows, fanout):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in sources:
        ordered = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        made[s] = (ordered, *climb([leaf_of(r) for r in ordered], fanout))
    root, upper = climb([made[s][1] for s in sources], fanout)
    wanted = Counter()
    for s, above in zip(sources, upper, strict=True):
        ordered, subroot, ways = made[s]
        for row, way in zip(ordered, ways, strict=True):
            whole = way + above
            cut = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            folded = leaf_of((*row[:4], row[4].replace("\n", ""))) if cut else leaf_of(row)
            for before, after in whole:
                folded = sha("".join([*before, folded, *after]))
            proof = sha("".join("".join(before + after) for before, after in whole))
            wanted[(row[0], leaf_of(row), subroot, root, proof, folded, folded == root)] += 1
    return wanted


@pytest.mark.parametrize("fanout, block_rows", [(3, 200_000), (3, 20), (2, 20)])
def test_merkle_manifest(spark, ws, fanout, block_rows):
    rng = random.Random(3)
    rows = [
        (rng.choice([i, i, 1000 - i]), rng.choice(["hot", "hot", "s1", "é", None, ""]), rng.choice(["en", None, ""]), rng.choice([i, None]),
         rng.choice(["a\nb", "\n", "", None, "plain é", "x\r\n"]))
        for i in range(120)
    ]
    rows += [(7, "alone", "en", 1, "one\nmore"), (None, "hot", None, None, "a\nb"), (5, "long", "en", 1_000_000, "wé\n" * 330_000)]
    rows += rows[:2] + rows[:2] + rows[-2:-1] + [rows[0]] * 40
    found = merkle.proof_report(merkle.manifest(ws, docs_of(spark, rows), fanout, block_rows))
    wanted = brute_manifest(rows, fanout)
    assert counted(found) == wanted
    assert {key[-1] for key in wanted} == {True, False}


def test_small_manifests(spark, ws):
    assert merkle.manifest(ws, docs_of(spark, [])).count() == 0
    row = (4, None, None, None, None)
    found = merkle.proof_report(merkle.manifest(ws, docs_of(spark, [row]))).first()
    assert found.leaf == found.subroot == found.root == found.folded_root == leaf_of(row) and found.proof_sha256 == sha("") and found.verified


# --- SuperMinHash -------------------------------------------------------------------

TEXTS = "doc_id long, text string, class int, size string, bucket string, component int"


def texts_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "b", 2) for r in rows], TEXTS).repartition(3)


def plain_signature(elements, slots):
    """One element after the other, each with its own permutation."""
    best = [superminhash._ALL_BITS] * slots
    for element in elements:
        order = list(range(slots))
        for j in range(slots):
            draw = int(superminhash.mix(np.array([(int(element) + (j + 1) * superminhash._STEP) % 2**64], np.uint64))[0])
            k = j + ((draw >> 40) * (slots - j) >> 24)
            order[j], order[k] = order[k], order[j]
            best[order[j]] = min(best[order[j]], j << 40 | draw & (1 << 40) - 1)
    return best


def test_signatures_equal_the_plain_form():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 3, 0, 40, 500])
    elements = rng.integers(0, 1 << 63, sizes.sum(), np.uint64)
    made = superminhash.signatures(elements, sizes, 32)
    ends = np.cumsum(sizes)
    for row, size, end in zip(made, sizes, ends, strict=True):
        assert row.tolist() == plain_signature(elements[end - size : end], 32)


def test_equal_slots_estimate_similarity_with_less_variance():
    rng = np.random.default_rng(2)
    shares = []
    for _ in range(150):
        pool = rng.integers(0, 1 << 63, 115, np.uint64)
        pair = np.concatenate([pool[:100], pool[15:]])
        a, b = superminhash.signatures(pair, np.array([100, 100]), 128)
        shares.append((a == b).mean())
    truth = 85 / 115
    assert abs(np.mean(shares) - truth) < 0.01
    assert np.var(shares) < 0.9 * truth * (1 - truth) / 128


def brute_groups(rows, percent, n):
    sets = []
    for _, text in rows:
        words = SPACED.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(a & b)
            if a and b and 100 * shared >= percent * (len(a) + len(b) - shared):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, row in enumerate(rows):
        ids[root(i)].append(row[0])
    least = [min((x for x in ids[root(i)] if x is not None), default=None) for i in range(len(rows))]
    return Counter((row[0], len(s), low, row[0] == low) for row, s, low in zip(rows, sets, least, strict=True))


@pytest.mark.parametrize("rounds, bucket_rows", [(3, 1024), (0, 7), (1, 1024)])
def test_near_duplicates(spark, ws, rounds, bucket_rows):
    """Groups of near copies whose similarities lie around the limit, chains, copies and odd texts."""
    rng = random.Random(9)
    vocabulary = [f"wé{i}" for i in range(300)] + ["A", "b", "C9"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(40)]
    for size in (60, 90, 150):
        base = rng.choices(vocabulary, k=size)
        for _ in range(40):
            near = list(base)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(size)] = rng.choice(vocabulary)
            texts.append(rng.choice(" \n\t").join(near))
    chain = rng.choices(vocabulary, k=80)
    for step in range(12):
        texts.append(" ".join(chain[step * 2 :] + chain[: step * 2]))
    long = " ".join(rng.choices(vocabulary, k=200_000))
    texts += [long, long + " tail", "x" * 1_000_000, "", " \t\n", "one", "One", "a b", "A B", texts[3], texts[60], "x " * 90, "x " * 95]
    rows = [(i * 7 % 997, t) for i, t in enumerate(texts)]
    rows += [(995, None), (None, texts[50]), (None, "of its own"), rows[1], rows[1], (995, None)]
    wanted = brute_groups(rows, 85, 3)
    assert counted(superminhash.near_duplicates(ws, texts_of(spark, rows), rounds=rounds, bucket_rows=bucket_rows)) == wanted
    assert len({key[2] for key in wanted}) < len(rows) - 80


def test_no_documents(spark, ws):
    assert superminhash.near_duplicates(ws, texts_of(spark, [])).count() == 0
    assert superminhash.near_duplicates(ws, texts_of(spark, [(1, None), (None, "")])).count() == 2


def test_sets_join_the_buckets_once(spark, ws, monkeypatch):
    """What is left in buckets is counted without sketches and sets; each row gets its class's once, after that."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for doc_id in range(60):
        words = list(base)
        for _ in range(rng.randint(2, 6)):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((doc_id, " ".join(words)))
    counted_columns, real = [], superminhash.key_fanout

    def spy(df, *rest):
        counted_columns.append(set(df.columns))
        return real(df, *rest)

    monkeypatch.setattr(superminhash, "key_fanout", spy)
    found = superminhash.near_duplicates(ws, texts_of(spark, rows), rounds=1, bucket_rows=8)
    assert counted(found) == brute_groups(rows, 85, 3)
    assert counted_columns and not any(columns & {"sketch", "elements"} for columns in counted_columns)
