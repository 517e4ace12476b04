"""Corpus pipeline: language, near duplicates, benchmark leaks, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiscope.llm import decontaminate, language_id, ngram_join, packing, queries, secret_scan
from lexiscope.llm.common import ready, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or a clear language go."""
    ready(spark)
    return language_id.keep_known(docs, queries.language_model(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ready(spark)
    return ngram_join.drop_near_duplicates(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ready(spark)
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked."""
    ready(spark)
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens, with their ids."""
    ready(spark)
    return packing.pack(docs)


STAGES = [("language", known_language), ("near_duplicates", one_of_each), ("benchmark", without_leaks),
          ("secrets", without_secrets), ("packing", packed)]

#: No stage but the third could be written in SQL; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    ready(spark)
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
