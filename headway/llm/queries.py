"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import headway
from headway.llm import decontamination, doubling, identifiers, jaccard, language, line_chunks, merkle, mixing, phrases, suffixes, superminhash, tries, warc
from headway.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


class Tables:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.ws = spark, folder, Workspace(spark)
        find_package(spark)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    On a cluster it is installed or sent with ``--py-files``.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(headway.__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def _query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


@_query
def op1_decontamination(t: Tables) -> DataFrame:
    return decontamination.contamination_report(decontamination.find_contamination(t.ws, t.documents, t.benchmark))


@_query
def op2_ngram_jaccard(t: Tables) -> DataFrame:
    return jaccard.similar_groups(t.ws, t.documents)


@_query
def op4_language_id(t: Tables) -> DataFrame:
    predicted = language.predict(t.documents, language.fit(t.ws, t.documents))
    return predicted.select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", F.round("score", 6).alias("score"), "rejected"
    )


@_query
def op5_line_dedup(t: Tables) -> DataFrame:
    return line_chunks.line_report(line_chunks.without_repeats(t.ws, t.documents, line_chunks.line_pairs))


@_query
def op9_source_mixing(t: Tables) -> DataFrame:
    return mixing.mix_sources(t.ws, t.documents).drop("source")


@_query
def op10_warc(t: Tables) -> DataFrame:
    merged = warc.capture_histories(t.ws, t.pages)
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op7_doubling(t: Tables) -> DataFrame:
    return doubling.without_repeated_windows(t.ws, t.documents)


@_query
def op6_suffix_merge(t: Tables) -> DataFrame:
    return suffixes.without_repeated_bytes(t.ws, t.documents)


@_query
def op3_phrase_fingerprints(t: Tables) -> DataFrame:
    made = phrases.fingerprints(t.ws, t.documents)
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


@_query
def op8_identifiers(t: Tables) -> DataFrame:
    return identifiers.identifier_report(identifiers.find_identifiers(t.ws, t.documents))


@_query
def op12_merkle_manifest(t: Tables) -> DataFrame:
    return merkle.proof_report(merkle.manifest(t.ws, t.documents))


@_query
def op11_prefix_trie(t: Tables) -> DataFrame:
    return tries.prefix_trie(t.ws, t.conversations)


@_query
def op13_superminhash(t: Tables) -> DataFrame:
    return superminhash.near_duplicates(t.ws, t.documents)
