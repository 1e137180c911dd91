"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tradeline.llm import chat, decontaminate, fingerprints, langid, minhash, neighbours, oracles, packing, pages, periods, quality, substrings, tokens, whitening
from tradeline.llm.common import prepare, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    hard = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.digests(chat.format_conversations(rows))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.collapse_runs(periods.with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_next(table(spark, sf_dir, "documents"))


Query = Callable[[SparkSession, str], DataFrame]


def _prepared(query: Query) -> Query:
    """``query`` in a session made fit for it."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _prepared(query)
    for query in (
        op1_quality_classifier,
        op2_minhash_dedup,
        op3_token_counts,
        op4_nearest_neighbours,
        op5_html_extraction,
        op6_decontamination,
        op7_packing,
        op8_chat_format,
        op9_language_id,
        op10_substring_dedup,
        op11_periodic_runs,
        op12_embedding_whitening,
        op13_document_fingerprints,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = oracles.ORACLES
