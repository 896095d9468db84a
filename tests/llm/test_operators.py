"""Each operator against plain Python on small tables with nulls, ties, repeats and odd columns."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import (
    decontamination,
    doubling,
    graph,
    identifiers,
    jaccard,
    language,
    line_chunks,
    mixing,
    phrases,
    suffixes,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, _key string, _lines int, places string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    full = [(i, t, "en" if t and i and i % 2 else None, None if i is None else f"s{i % 3}", "k", 1, "p") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def counted(df):
    return Counter(tuple(None if x is None else x for x in row) for row in df.collect())


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def documents():
    """Passages shared by many texts, copies, near copies, runs of one symbol, odd and empty texts."""
    rng = random.Random(11)
    vocabulary = [f"wé{i}" for i in range(60)] + ["A", "b", "C9"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 60))] for _ in range(5)]
    texts = []
    for _ in range(70):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            words += rng.choice(passages)[rng.randint(0, 8) :] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 9))]
        texts.append("".join(w + rng.choice("  \n\t") for w in words))
    base = [rng.choice(vocabulary) for _ in range(80)]
    for _ in range(25):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(80)] = rng.choice(vocabulary)
        texts.append(" ".join(near))
    texts += ["x " * 90, "a" * 350, "ab" * 150, "\0" * 250, "", " \t\n", "one", "One", "a b", "A B", texts[3], texts[4], texts[4] + "\n"]
    rows = [(i * 7 % 997, t) for i, t in enumerate(texts)] + [(995, None), (None, texts[5])]
    return rows + [rows[1], rows[1], (995, None)]


def test_decontamination(spark, ws, documents):
    items = [(1, documents[2][1]), (2, "One"), (3, None), (4, " .. "), (5, documents[72][1]), (5, documents[72][1]), (None, "ab" * 150)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i : i + size])].add("null" if item is None else str(item))
    wanted = Counter()
    for doc_id, text in documents:
        words, hit, names = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= found
        wanted[(doc_id, len(words), len(hit), len(names), digest(",".join(sorted(names)).encode()), bool(hit))] += 1
    for block_bytes in (decontamination.BLOCK_BYTES, 200):
        found = decontamination.find_contamination(ws, table(spark, documents), bench, block_bytes=block_bytes)
        assert counted(decontamination.contamination_report(found)) == wanted
    for row in found.collect():
        for span in row.spans:
            assert not re.search(r"^\W|\W$", row.text[span.start : span.end], re.ASCII) or "é" in row.text
    kept = decontamination.drop_contaminated(ws, table(spark, documents), bench)
    assert kept.count() == sum(n for key, n in wanted.items() if not key[-1]) and len(kept.columns) == 7
    assert decontamination.find_contamination(ws, table(spark, []), bench).count() == 0
    assert decontamination.drop_contaminated(ws, table(spark, documents), bench.filter("false")).count() == len(documents)


def groups_of(rows):
    sets = []
    for _, text in rows:
        words = WORD.findall(lower(text))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(a & b)
            if a and b and 100 * shared >= 75 * (len(a) + len(b) - shared):
                parent[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


def test_jaccard_groups(spark, ws, documents):
    sets, roots = groups_of(documents)
    ids = defaultdict(list)
    for (doc_id, _), root in zip(documents, roots, strict=True):
        ids[root].append(doc_id)
    least = {root: min((i for i in known if i is not None), default=None) for root, known in ids.items()}
    wanted = Counter((doc[0], len(s), least[r]) for doc, s, r in zip(documents, sets, roots, strict=True))
    assert counted(jaccard.similar_groups(ws, table(spark, documents))) == wanted
    assert counted(jaccard.similar_groups(ws, table(spark, documents), list_rows=5)) == wanted
    kept = jaccard.one_of_each_group(ws, table(spark, documents))
    linked = {least[r] for s, r in zip(sets, roots, strict=True) if s}
    alone = {doc for doc, s in zip(documents, sets, strict=True) if not s}
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.filter(F.trim("text") != "").collect() if WORD.search(r.text)) == sorted((i is None, i) for i in linked)
    assert kept.count() == len(linked) + len(alone) and kept.columns == table(spark, []).columns
    assert jaccard.similar_groups(ws, table(spark, [])).count() == 0


def test_heads_name_the_lists_of_a_class(spark, ws, monkeypatch):
    """Each pair is handed on from one list: heads name the lists that are still there, not the first n-grams."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    docs = []
    for doc_id in range(30):
        words = list(base)
        for _ in range(rng.randint(8, 30)):
            words[rng.randrange(400)] = f"e{rng.randrange(10**6)}"
        docs.append((doc_id, " ".join(words)))
    seen, real = {}, jaccard._open_pairs

    def spy(lists, members, *rest):
        seen.update(lists=lists, members=members)
        return real(lists, members, *rest)

    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(jaccard, "_open_pairs", spy)
    sets, roots = groups_of(docs)
    found = {r.doc_id: r.component_id for r in jaccard.similar_groups(ws, table(spark, docs)).collect()}
    assert found == {doc_id: min(i for i, r in enumerate(roots) if r == roots[doc_id]) for doc_id, _ in docs}
    listed = defaultdict(list)
    for row in seen["lists"].collect():
        listed[row["class"]].append((row.place, row.gram))
    heads = {row["class"]: row.head for row in seen["members"].collect()}
    assert heads == {name: [gram for _, gram in sorted(known)][: jaccard.HEAD] for name, known in listed.items()}
    assert max(place for known in listed.values() for place, _ in known) > 16


def test_open_pairs_stay_in_their_tasks(spark, ws, monkeypatch):
    """Near misses make pairs with the square of their number; what tasks hand on grows with the classes."""
    rng = random.Random(5)
    base, docs = [f"w{i}" for i in range(300)], []
    for doc_id in range(120):
        words = list(base)
        for _ in range(rng.randint(4, 12)):
            words[rng.randrange(300)] = f"e{rng.randrange(10**6)}"
        docs.append((doc_id, " ".join(words)))
    rows = {}

    def counting(name, real):
        def spy(*args):
            out = real(*args)
            rows[name] = rows.get(name, 0) + out.count()
            if name == "_open_pairs":
                rows["classes"] = args[0].select("pivot", "class").distinct().count()
            return out

        monkeypatch.setattr(jaccard, name, spy)

    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 0)
    counting("_open_pairs", jaccard._open_pairs)
    counting("_links_of_open", jaccard._links_of_open)
    sets, roots = groups_of(docs)
    near = sum(100 * len(a & b) >= 65 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    wanted = {doc_id: min(i for i, r in enumerate(roots) if r == roots[doc_id]) for doc_id, _ in docs}
    for set_grams in (jaccard.SET_GRAMS, 5_000):
        rows.clear()
        found = {r.doc_id: r.component_id for r in jaccard.similar_groups(ws, table(spark, docs), set_grams=set_grams).collect()}
        assert found == wanted
        assert 0 < rows["_open_pairs"] <= rows["classes"] and near > 10 * len(docs)
    assert len(set(wanted.values())) > 1


def test_components_of_several_tasks(spark, ws):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (5000, 5000)]
    parent = {}

    def root(node):
        while parent.get(node, node) != node:
            node = parent[node]
        return node

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    wanted = sorted({(node, root(node)) for edge in edges for node in edge if edge[0] != edge[1]})
    table_of = spark.createDataFrame(edges + edges[:20], "a long, b long").repartition(5)
    for links_per_task in (graph.LINKS_PER_TASK, 40):
        assert sorted(tuple(r) for r in graph.components(ws, table_of, links_per_task).collect()) == wanted
    assert graph.components(ws, table_of.filter("a = b")).count() == 0


def test_fingerprints(spark, ws, documents, monkeypatch):
    order = sorted(documents, key=lambda d: (d[0] is None, -(d[0] or 0)))
    wanted = Counter()
    for place, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(place + 1) % len(order)][1] or ""
        half = len(text) // 2
        wanted[(doc_id, len(text), text[: len(text) - half] + after[:half])] += 1
    for size in (4_000_000, 700):
        monkeypatch.setattr(phrases, "RANGE_BYTES", size)
        made = phrases.fingerprints(ws, table(spark, documents)).cache()
        assert counted(made.select("doc_id", "n_chars", "edited")) == wanted
    texts = {i: t or "" for i, t in documents}
    by_text = defaultdict(set)
    for row in made.collect():
        by_text[texts[row.doc_id]].add(row.fingerprint)
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert row.edited != texts[row.doc_id] or row.near_edited == 1
    assert all(len(prints) == 1 for prints in by_text.values())
    assert phrases.fingerprints(ws, table(spark, [])).count() == 0
    assert phrases.fingerprints(ws, table(spark, [(4, "abc")])).select("edited").first()[0] == "aba"


def test_equal_substrings_share_signatures():
    rng = random.Random(2)
    shared = "".join(rng.choice("abcdefghij ") for _ in range(6000))
    a, b, c = phrases.sketches(["xyz" * 9 + shared, "q" + shared + "end", shared[::-1]])
    assert phrases.likeness(a, b) > 0.9 and phrases.likeness(a, c) < 0.1
    assert phrases.likeness(a[:0], a[:0]) == 1 and phrases.likeness(a, a[:0]) == 0


def test_language(spark, ws):
    rng = random.Random(3)
    sounds = {"aa": ["ba", "lo", "mi"], "bb": ["ché", "rö", "ßu"], "cc": ["str", "ing", "th"]}
    rows = []
    for i in range(240):
        lang = list(sounds)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(sounds[lang], k=3)) for _ in range(30)), lang, "s"))
    odd = [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "12 ?!", "bb", "s"), (903, "é", None, None), (None, "lomiba", None, "s"), rows[0]]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = language.fit(ws, docs, per_language=40)
    assert sorted(set(model.languages)) == ["aa", "bb", "cc"] and len(model.languages) > 3
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert len(got) == 245 and all(got[i].lang_pred == lang for i, _, lang, _ in rows)
    assert all((got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0, True) for i in (900, 901, 902))
    assert got[903].lang_pred in sounds and got[None].lang_pred == "aa"
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows + odd) - sum(r.rejected for r in got.values())
    # Nothing to learn from, and nothing to predict.
    assert language.fit(ws, docs.filter("lang is null")) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert language.predict(docs.filter("false"), model).count() == 0


def test_far_texts_are_rejected(spark, ws):
    rng = random.Random(8)
    sounds = {"aa": ["ba", "lo", "mi", "ke"], "bb": ["ché", "rö", "ßu", "wä"], "cc": ["str", "ing", "th", "ou"]}
    word = lambda lang: "".join(rng.choices(sounds[lang], k=rng.randint(1, 4)))
    learned = [(i, " ".join(word(list(sounds)[i % 3]) for _ in range(rng.randint(1, 60))), list(sounds)[i % 3]) for i in range(600)]
    learned += [(600 + i, f"{word(lang)} " * 400, lang) for i, lang in enumerate(sounds)]
    far = ["".join(rng.choices("абвгдежзиклмн  ", k=n)) for n in (60, 200, 2000)]
    far += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz  ", k=n)) for n in (100, 300, 2000)]
    far += ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n)) for n in (20, 400)]
    docs = spark.createDataFrame(learned + [(1000 + i, t, None) for i, t in enumerate(far)], "doc_id long, text string, lang string")
    for count in (1, language.CENTROIDS):
        model = language.fit(ws, docs, per_language=150, count=count)
        assert {r.doc_id for r in language.predict(docs, model).filter("rejected").collect()} == set(range(1000, 1000 + len(far)))
        assert {r.doc_id for r in language.keep_known(docs, model).collect()} == {i for i, _, _ in learned}


def test_line_chunks(spark, ws):
    rng = random.Random(4)
    lines = [f"line {i} é" for i in range(12)] + ["", ""]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    block = "\n".join(f"shared {i}" for i in range(20))
    texts += [block, "before\n" + block, "more\nlines\nbefore\n" + block + "\nafter", "", None]
    rows = [(i * 5 % 101, t) for i, t in enumerate(texts)] + [(None, texts[1]), (7000, block)]
    rows.append(rows[2])
    seen, kept = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda d: (d[0] is None, d[0] or 0, d[1] or "")):
        body, left, gone = (text or "").encode(), [], 0
        for start, end, count in line_chunks.cut_chunks(body):
            if count >= 2 and body[start:end] in seen:
                gone += count
                continue
            seen.add(body[start:end])
            left.append(body[start:end])
        kept[(doc_id, text)] = (doc_id, len(body.split(b"\n")) if body else 0, gone, digest(b"\n".join(left)))
    cleaned = line_chunks.without_repeats(ws, table(spark, rows))
    assert counted(line_chunks.line_report(cleaned)) == Counter(kept[row] for row in rows)
    assert cleaned.columns[:7] == table(spark, []).columns
    # Lines put in front don't shift the boundaries of what follows.
    assert cleaned.filter("doc_id = 7000").first()._lines_removed >= 16
    assert line_chunks.without_repeats(ws, table(spark, [])).count() == 0


def without_repeated_pairs(rows):
    """``(doc_id, lines, removed, text)`` by row: lines that are in a pair of neighbours that stood before."""
    seen, wanted = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda d: (d[0] is None, d[0] or 0, hashlib.md5(repr(d).encode()).digest())):
        lines, gone = (text.split("\n") if text else []), set()
        for k, pair in enumerate(zip(lines, lines[1:])):
            gone |= {k, k + 1} if pair in seen else set()
            seen.add(pair)
        left = "\n".join(line for k, line in enumerate(lines) if k not in gone)
        wanted[(doc_id, text)] = (doc_id, len(lines), len(gone), left if text else text)
    return wanted


@pytest.mark.parametrize("key_bytes", [16, 1])
def test_every_repeated_run_of_lines_goes(spark, ws, key_bytes):
    rng = random.Random(9)
    rows, runs = [], [[f"run {r} line {k} é" for k in range(rng.randint(2, 6))] for r in range(12)]
    for i in range(80):
        lines = []
        for n in range(rng.randint(1, 4)):
            lines += [f"own {i} {n} {k}" for k in range(rng.randint(0, 2))] + rng.choice(runs)
        rows.append((i * 37 % 101, "\n".join(lines)))
    rows += [(200, "one\n" * 9), (201, "x\none\none"), (202, rows[0][1]), (203, "one"), (204, None), (205, ""), (None, rows[1][1]), rows[2]]
    wanted = without_repeated_pairs(rows)
    cleaned = line_chunks.without_repeats(ws, table(spark, rows), line_chunks.line_pairs, key_bytes)
    got = cleaned.select("doc_id", cleaned.columns[-2], cleaned.columns[-1], "text")
    assert counted(got) == Counter(wanted[row] for row in rows)
    kept = Counter(tuple(run) for row in set(rows) for run in runs if "\n".join(run) in (wanted[row][3] or ""))
    assert set(kept.values()) == {1}


def test_line_query_and_stage_remove_every_repeated_run(spark, ws, tmp_path):
    import corpus_pipeline
    from headway.llm import queries

    rows = [(1, "a\nfirst\nsecond\nb"), (2, "c\nfirst\nsecond\nd"), (3, "first\nsecond"), (4, "é\nc\nfirst")]
    rows += [(i, f"p{i}\nleft {i % 5}\nright {i % 5}\nq{i}") for i in range(10, 40)]
    wanted = without_repeated_pairs(rows)
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in queries.queries()["op5_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {i: (n, gone, digest(left.encode())) for i, n, gone, left in wanted.values()}
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    stage = corpus_pipeline.remove_repeated_lines(spark, docs, str(tmp_path))
    assert counted(stage) == Counter((i, left, len(left)) for i, _, _, left in wanted.values())


def test_repeated_bytes(spark, ws, documents):
    seen, wanted = set(), {}
    for doc_id, text in sorted(set(documents), key=lambda d: (d[0] is None, d[0] or 0)):
        body = (text or "").encode()
        covered = np.zeros(len(body), bool)
        for i in range(len(body) - 99):
            if body[i : i + 100] in seen:
                covered[i : i + 100] = True
            seen.add(body[i : i + 100])
        spans = int(np.count_nonzero(covered & ~np.append(False, covered[:-1]))) if len(body) else 0
        wanted[(doc_id, text)] = (doc_id, len(body), int(covered.sum()), spans, digest(bytes(np.frombuffer(body, np.uint8)[~covered])))
    got = counted(suffixes.without_repeated_bytes(ws, table(spark, documents)))
    assert got == Counter(wanted[row] for row in documents)
    assert sum(row[2] > 0 for row in got) > 30
    assert suffixes.without_repeated_bytes(ws, table(spark, [])).count() == 0


def test_merging_shards_is_sorting():
    rng = np.random.default_rng(5)
    shards = [np.array(sorted(map(bytes, rng.integers(0, 2, (n, 24), np.uint8)))) for n in (40, 1, 0, 25)]
    rows = np.array([np.frombuffer(r.ljust(24, b"\0"), np.uint8) for shard in shards for r in shard])
    order, common = suffixes.refine_interleave(rows)
    merged = [bytes(rows[i]) for i in order]
    assert merged == sorted(map(bytes, rows))
    for i in range(1, len(merged)):
        same = next((k for k in range(24) if merged[i][k] != merged[i - 1][k]), 24)
        assert common[i] == same


def test_repeated_windows(spark, ws, documents):
    once = set(documents)
    windows = Counter()
    for _, text in once:
        words = WORD.findall(text or "")
        windows.update(tuple(words[i : i + 35]) for i in range(len(words) - 34))
    wanted = Counter()
    for doc_id, text in documents:
        words, gone = WORD.findall(text or ""), set()
        for i in range(len(words) - 34):
            if windows[tuple(words[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        wanted[(doc_id, len(words), len(gone), digest(kept.encode()))] += 1
    assert counted(doubling.without_repeated_windows(ws, table(spark, documents))) == wanted
    assert doubling.lengths() == [9, 18, 35]
    assert doubling.without_repeated_windows(ws, table(spark, [])).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    spans = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            if kind == "ip" and any(int(p) > 255 for p in match.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((match.start(), match.end(), kind))
    return sorted(spans, key=lambda s: (s[0], list(PLAIN).index(s[2])))


def test_fixed_forms_equal_the_plain_patterns():
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choice(rng.choice(["0123456789. ", "@a.-b", "+() -12", "1.2.", "é@.a1"])) for _ in range(rng.randint(0, 40)))
        assert identifiers.fixed_spans(text) == plain_spans(text), text
    # Long runs stay linear.
    assert identifiers.fixed_spans("1" * 200_000 + "a" * 200_000 + "." * 9) == []


def test_identifiers_by_context(spark, ws):
    rows = [(i, f"please write to u{i}@mail.com now") for i in range(6)]
    rows += [(10, "é please write to admin@localhost now"), (11, "other words x9 y"), (12, None), (13, ""), (None, "write to +1 (555) 000-1234")]
    rows += [(14, "seen at r2d2"), (15, "seen at 10.0.0.1"), rows[0]]
    got = identifiers.identifier_report(identifiers.find_identifiers(ws, table(spark, rows)))
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert spans[10] == "email:18:33" and spans[0] == "email:16:27"
    assert spans[11] == spans[12] == spans[13] == spans[14] == "" and spans[15] == "ip:8:16"
    assert got.count() == len(rows) and spans[None].startswith("phone:9:")
    assert identifiers.find_identifiers(ws, table(spark, [])).count() == 0


def added_by_context(spark, ws, texts):
    rows = list(enumerate(texts))
    got = {r.doc_id: r.added for r in identifiers.find_identifiers(ws, table(spark, rows)).collect()}
    return {(texts[i][s.start : s.end], s.kind) for i in got for s in got[i]}


def test_any_word_or_run_of_numbers_may_be_an_identifier(spark, ws):
    texts = [f"my phone : +1 555 000 {i}234 please" for i in range(20)]
    texts += ["my phone : 555-123-4567 please", "my phone (017) 555-7713 please", "My PHONE ... 99 12 34"]
    texts += [f"write É to u{i}@mail.com now" for i in range(9)] + ["so write é to johnsmith, now", "my phone fell"]
    assert added_by_context(spark, ws, texts) == {
        ("555-123-4567", "phone"), ("017) 555-7713", "phone"), ("99 12 34", "phone"), ("johnsmith", "email")
    }


def test_identifiers_two_hops_away_and_patterns_of_few_seeds(spark, ws):
    texts = [f"please contact via u{i}@mail.com now" for i in range(20)] + [f"please contact via nick{i} now" for i in range(4)]
    # Only found values stand in the second context, and something new.
    texts += [f"he is known as nick{i} here" for i in range(4)] + ["he is known as faraway here"]
    # Three seeds among seven values.
    texts += [f"they saw near v{i}@mail.com again" for i in range(3)] + [f"they saw near {w} again" for w in ("tree", "house", "town", "river")]
    assert added_by_context(spark, ws, texts) == {*((f"nick{i}", "email") for i in range(4)), ("faraway", "email")}


def test_identifiers_four_hops_away(spark, ws):
    """Each context is known by the names that the one before it has found."""
    names = [f"name{i}" for i in range(40)]
    texts = [f"contact via u{i}@mail.com now" for i in range(200)] + [f"contact via {n} now" for n in names]
    for hop, known in enumerate((40, 20, 8, 5), 1):
        new = known // 4
        names = names[:known] + [f"far{hop}x{i}" for i in range(new)]
        texts += [f"some words hop{hop} knows {n} here" for n in names]
        names = names[-new:] + names[: known // 2]
    found = {value for value, _ in added_by_context(spark, ws, texts)}
    assert {f"far{hop}x0" for hop in (1, 2, 3, 4)} <= found


def test_mixing(spark, ws):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randint(0, 300), rng.choice(["hot", "hot", "b", "c", None, "é"])) for i in range(300)]
    rows += [(900, None, "c"), (None, "a b", "b"), (901, "x", "tiny"), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("?"))
    got = mixing.mix_sources(ws, docs).collect()
    assert len(got) == len(rows)
    total, sizes, targets, taken = 0, Counter(), {}, Counter()
    for r in got:
        total += r["size"]
        sizes[r.source] += r["size"]
        targets[r.source] = r.target
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sum(len(t.split()) for _, t, s in rows if s == r.source and t)
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    assert all(targets[s] <= 3 * sizes[s] + 1e-9 and abs(taken[s] - targets[s]) <= 6 for s in sizes)
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    free = [s for s in sizes if targets[s] < 3 * sizes[s] - 1e-9]
    assert len({round(targets[s] / weights[s], 6) for s in free}) == 1
    assert sorted(map(repr, mixing.mix_sources(ws, docs).collect())) == sorted(map(repr, got))
    assert mixing.mix_sources(ws, docs.filter("false")).count() == 0


def test_small_sources_beside_a_very_large_one(spark, ws):
    """The miss follows a source's own size, not that of the whole: 3 in 1000, or a few words."""
    sizes = {"a": 300, "b": 9, "c": 2_000_000, "d": 1, "e": 4_003, "f": 8_200}
    rows = [(k * 1000 + i, "w " * words, name) for k, (name, size) in enumerate(sizes.items()) for i, words in enumerate([size // 3, size - size // 3])]
    got = mixing.mix_sources(ws, spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg(
        F.max("target").alias("target"), F.sum("taken").alias("taken"))
    for r in got.collect():
        assert abs(r.taken - r.target) <= max(6, 0.01 * sizes[r.source]), r


def test_archives(spark, ws):
    rows = [(1, "http://A.com/x", "a\r\n\r\nb"), (2, None, None), (3, "http://[bad", "a\r\n\r\nb"), (None, "u\nv w", "é")]
    rows += [(4, "http://www.a.com", ""), (5, "https://b.org/?q=1", "WARC/1.1\r\n"), rows[0]] + [(10 + i, f"http://c.de/{i % 3}", "same") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    merged = warc.capture_histories(ws, pages, records=4)
    got = merged.collect()
    first = {}
    for page, _, html in rows:
        body = html or ""
        first[body] = min(first.get(body, 1 << 60), 1 << 60 if page is None else page)
    wanted = Counter()
    for page, _, html in rows:
        body = html or ""
        revisit = page != first[body] and first[body] < 1 << 60
        wanted[(page, len(body.encode()), "revisit" if revisit else "response", first[body] if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == wanted
    keys = [(r.url_key, r.captured) for r in got]
    assert keys == sorted(keys) and "com,a)/x" in [k for k, _ in keys]
    for least, responses in ((3, 7), (100, len(rows))):
        types = Counter(r.record_type for r in warc.capture_histories(ws, pages, least_bytes=least).collect())
        assert types["response"] == responses
    assert warc.capture_histories(ws, pages.filter("false")).count() == 0


def test_loser_tree_merges_any_runs():
    rng = random.Random(8)
    for count in range(9):
        runs = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 6))) for _ in range(count)]
        assert list(warc.LoserTree(runs, lambda row: row)) == sorted(x for run in runs for x in run)
