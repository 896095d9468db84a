"""A corpus from raw documents to a mix: each stage reads the documents the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import decontamination, jaccard, language, line_chunks, mixing
from headway.llm.queries import find_package
from headway.sources.workspace import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# Python workers live on between stages. These settings of the C library and of Arrow let them give
# large arrays back to the machine, so that one stage's peak is not held through the next.
WORKER_SETTINGS = {
    "MALLOC_MMAP_THRESHOLD_": str(16 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(64 << 20),
    "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


# Rows go to Python workers by this many bytes at most, however long their texts are: the buffers for them
# are outside the heap, on both sides.
BATCH_BYTES = 4 << 20


def _prepare(spark: SparkSession) -> None:
    find_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.sparkContext.environment.update(WORKER_SETTINGS)


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with ``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is far from every language, or has no letter, go."""
    _prepare(spark)
    return language.keep_known(docs, language.fit(Workspace(spark), docs))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occurred before go, found by content-defined chunks and pairs of lines; a document
    that was nothing else stays, empty."""
    _prepare(spark)
    return _with_length(line_chunks.without_repeats(Workspace(spark), docs, line_chunks.chunks_and_pairs), docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates stays."""
    _prepare(spark)
    return jaccard.one_of_each_group(Workspace(spark), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    _prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(Workspace(spark), docs, benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document; see ``mixing.mix_sources``."""
    return mixing.mix_sources(Workspace(spark), docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("ngram_jaccard_join", join_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix),
]

# Nearest centroids and content-defined chunks have no SQL; the tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return docs
