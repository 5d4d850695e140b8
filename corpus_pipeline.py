"""A training corpus from documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from clicklake.llm.common import table, written
from clicklake.llm.language import with_known_language
from clicklake.llm.line_dedup import without_repeated_lines
from clicklake.llm.minhash import without_near_duplicates
from clicklake.llm.mixing import mixed
from clicklake.llm.packing import packed_documents

#: Below this score a text resembles none of the learned languages; one unlike its best language has score 0.
MIN_SCORE = 0.2

#: Documents that a Python worker is handed at once: whole texts, of which it holds no more than these.
TEXTS_AT_ONCE = 500
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with the session's Arrow batches lowered to `TEXTS_AT_ONCE` rows, also for when its result is computed."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get(BATCH_ROWS))
        if rows <= 0 or rows > TEXTS_AT_ONCE:  # none or less is no limit
            spark.conf.set(BATCH_ROWS, TEXTS_AT_ONCE)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages."""
    return with_known_language(docs, min_score=MIN_SCORE)


@in_small_batches
def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one."""
    return without_repeated_lines(docs)


@in_small_batches
def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without_near_duplicates(docs)


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask."""
    return mixed(docs)


@in_small_batches
def sequences_of_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    return packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language identification", known_language),
    ("line dedup", unique_lines),
    ("MinHash near-dedup", unique_documents),
    ("mixing to target weights", target_weights),
    ("best-fit packing", sequences_of_documents),
]

#: The first, third and last stage have no SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
