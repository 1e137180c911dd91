"""Training corpus from raw documents: five stages, each by one of the operators of ``tradeline.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
``documents``. Language identification drops texts without a letter, near-duplicate removal keeps one
document of each group, substring removal cuts repeated passages (and drops a document that loses all
its text), decontamination drops documents that hold a benchmark question, packing gives the pieces of
sequences. Rows with a null doc_id pass the stages that compare documents unchanged.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeline.llm import decontaminate, langid, minhash, packing, substrings
from tradeline.llm.common import prepare, remove_folder, shared_folder, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.clean_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepared(stage: Stage) -> Stage:
    """``stage`` in a session made fit for it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _prepared(language_id)),
    ("near_dedup", _prepared(near_dedup)),
    ("substring_dedup", _prepared(substring_dedup)),
    ("decontamination", _prepared(decontamination)),
    ("packing", _prepared(pack_sequences)),
]

#: Learned machines and tokenizers can't be said in SQL; the tests follow the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written once to the shared folder and read again.

    A stage's folder is removed when the next one is written. The input of the last stage stays, as
    the returned frame reads it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/corpus-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
