"""Corpus pipeline: quality, near duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``. All but the last return rows of
``docs`` with all their columns; the last writes token shards and returns a row per sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laborlake.llm import decontaminate, mixing, quality, simhash, token_output
from laborlake.llm.common import read, staged

#: Contract of the near-duplicate stage: words per shingle and most differing bits.
SHINGLE_WORDS, MAX_BITS = 3, 2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (smallest doc_id) of each near-duplicate group."""
    return simhash.keep_first(docs, SHINGLE_WORDS, MAX_BITS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target weights."""
    return mixing.keep_sampled(docs)


def output_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; where each sequence is."""
    return token_output.ordered_output(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", output_stage),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and reread."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
