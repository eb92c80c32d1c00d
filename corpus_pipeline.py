"""The corpus pipeline: filter by quality, filter by language, keep one of near copies, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rewardloom.llm.common import documents, materialize, ship, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site posteriors accept."""
    from rewardloom.llm.quality import accepted_rows
    ship(spark)
    return accepted_rows(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the machines know."""
    from rewardloom.llm.langid import identified_rows
    ship(spark)
    return identified_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram links connect."""
    from rewardloom.llm.ngram_join import one_of_each
    ship(spark)
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the balanced mix takes it: not at all, once or twice."""
    from rewardloom.llm.cube import mixed_rows
    ship(spark)
    return mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    from rewardloom.llm.packing import pack as packed
    ship(spark)
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), "dropped", capacity=4096)


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies), ("mix", mix), ("pack", pack)]

# Fitted classifiers, sampling and tokenizing aren't SQL; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
