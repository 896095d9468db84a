"""The pipeline's stages, each against its own input: on the smallest tables, and row by row on a planted one."""

import random

import duckdb
import pytest

import __spark_entry__ as entries
import corpus_pipeline
from headway.llm import line_chunks
from .test_operators import without_repeated_pairs

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark, ws):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        made = ws.save(stage(spark, docs, FOLDER), name)
        sizes.append((docs.count(), made.count()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == columns and made.dtypes == docs.dtypes
            docs = made
    assert all(after <= before for before, after in sizes)
    assert sizes[0] == (200, 200) and sizes[1][0] == sizes[1][1] and sizes[2][0] > sizes[2][1] and sizes[3][0] > sizes[3][1]
    assert sizes[4][0] == sizes[4][1]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Real texts of the smallest table besides planted ones: junk, shared lines, copies, near copies, benchmark
    passages, one very long text, nulls and repeated rows."""
    folder = str(tmp_path_factory.mktemp("planted"))
    rng = random.Random(8)
    base = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").select("doc_id", "text", "lang", "source").collect()
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").collect()]
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in base]
    texts = [r.text for r in base if len(r.text.split()) > 60][:20]
    number = 10_000
    for k, text in enumerate(texts):
        words = text.split(" ")
        near = list(words)
        near[rng.randrange(len(near))] = "changed"
        for made in (text, " ".join(near), f"{text}\nshared line {k % 3}\nnext line {k % 3}\n", f"{text[:200]} {items[k % len(items)]} {text[200:]}"):
            rows.append((number, made, None, f"s{k % 4}"))
            number += 1
    rows += [(number + k, "".join(rng.choices("qxzjkvw", k=300)), None, "junk") for k in range(5)]
    rows += [(number + 10, "\n".join(texts) * 12, "en", "long"), (number + 11, None, None, None), (number + 12, "", "en", None), rows[3], rows[3]]
    docs = [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def sql_over(docs_folder, benchmark_folder, name):
    """The rows of an operator's SQL over some documents."""
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{docs_folder}/*.parquet'")
        db.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{benchmark_folder}/benchmark.parquet/*.parquet'")
        result = db.execute(entries.oracle_sql()[name])
        return [dict(zip([d[0] for d in result.description], row, strict=True)) for row in result.fetchall()]


def key(row):
    return repr((row.doc_id, row.text))


def test_every_stage_row_by_row(spark, planted, tmp_path):
    """The rows of the planted table after each stage, by plain Python or by the SQL of the operator over the
    stage's own input."""
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        made = stage(spark, docs, planted)
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after, given = docs.collect(), str(tmp_path / f"{name}-input")
        spark.createDataFrame(before, made.sparkSession.read.parquet(f"{planted}/documents.parquet").schema).write.parquet(given)
        if name == "language_id":
            gone = {r.doc_id for r in before} - {r.doc_id for r in after}
            assert {r.doc_id for r in before if r.source == "junk" or not r.text} <= gone
            assert not gone & set(range(200))
        elif name == "line_dedup":
            wanted = without_repeated_pairs([(r.doc_id, r.text) for r in before])
            assert sorted((repr((r.doc_id, r.text, r.n_chars)) for r in after)) == sorted(
                repr((r.doc_id, wanted[(r.doc_id, r.text)][3], len(wanted[(r.doc_id, r.text)][3]))) for r in before
            )
        elif name == "ngram_jaccard_join":
            groups = {row["doc_id"]: row["component_id"] for row in sql_over(given, planted, "op2_ngram_jaccard")}
            worded = [r for r in before if (r.text or "").split()]
            assert sorted(r.doc_id for r in after if (r.text or "").split()) == sorted({groups[r.doc_id] for r in worded})
            assert sorted({key(r) for r in after if not (r.text or "").split()}) == sorted({key(r) for r in before if not (r.text or "").split()})
            assert {key(r) for r in after} <= {key(r) for r in before}
        elif name == "benchmark_decontamination":
            hit = {row["doc_id"] for row in sql_over(given, planted, "op1_decontamination") if row["contaminated"]}
            assert hit and sorted(key(r) for r in after) == sorted(key(r) for r in before if r.doc_id not in hit)
        else:
            wanted = {(row["doc_id"], row["size"], row["source_size"], round(row["target"], 6), row["taken"]) for row in sql_over(given, planted, "op9_source_mixing")}
            assert {(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in after} == wanted


def test_registered_queries():
    names = entries.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13
    assert set(entries.oracle_sql()) <= set(names)


def test_line_stage_cuts_by_content_too(spark, monkeypatch):
    """The stage looks at content-defined chunks as well as at pairs; together they take what brute force takes."""
    cuts, plain = [], line_chunks.without_repeats

    def watched(ws, docs, cut=line_chunks.cut_chunks, *rest):
        cuts.append(cut)
        return plain(ws, docs, cut, *rest)

    monkeypatch.setattr(line_chunks, "without_repeats", watched)
    rng = random.Random(2)
    passages = [[f"line {k} {n}" for n in range(rng.randrange(2, 9))] for k in range(4)]
    rows = []
    for i in range(40):
        lines = [f"own {i} {n}" for n in range(rng.randrange(4))]
        rows.append((i, "\n".join([*lines, *rng.choice(passages), *rng.choice([[], ["same"] * 5, rng.choice(passages)])])))
    rows += [(50, None), (51, ""), rows[3]]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    got = corpus_pipeline.remove_repeated_lines(spark, docs, FOLDER).collect()
    wanted = without_repeated_pairs(rows)
    assert sorted(repr((r.doc_id, r.text)) for r in got) == sorted(repr((i, wanted[(i, t)][3])) for i, t in rows)
    text = max((t for _, t in rows if t), key=len).encode()
    chunks = [c for c in line_chunks.cut_chunks(text) if c[2] > 2]
    assert chunks and set(chunks) <= set(cuts[0](text)) and set(line_chunks.line_pairs(text)) <= set(cuts[0](text))
