"""Registered queries of the operators: each reads its whole tables with production parameters."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.llm import (conversation_repair, decontaminate, hard_negatives, katz_lm, language_id, license_scan, ngram_join, packing,
                           quality_rules, secret_scan, token_store, toxicity, url_reputation)
from lexiscope.llm.common import crc_mod
from lexiscope.llm.oracles import OP11, OP13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_lm.score_documents(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))

    @F.pandas_udf("long")
    def crc(ids: pd.Series, width: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.frombuffer(x, f"<u{w}").astype("<u4").tobytes())
                          for x, w in zip(ids, width)], dtype="int64")

    return pieces.select("doc_id", "start", "length", crc("ids", "width").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    return language_id.fit(docs.where(crc_mod("doc_id", 5) != 0))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return language_id.predict(rows, language_model(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op6_license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.find_licenses(docs).unionByName(license_scan.find_notices(docs), allowMissingColumns=True)


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.digests(spark, token_store.write_store(table(spark, sf_dir, "documents")))


def op8_quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_copies", "n_text_links", "n_links")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = docs.where(crc_mod("doc_id", 4) != 2)
    found = toxicity.score_documents(docs, toxicity.fit(training, table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                        "predicted", "n_toxic_words", "spans")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    rows = hard_negatives.integer_rows(given)
    return hard_negatives.mine(rows, rows.where(F.col("vec_id") % 100 == 0))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that the check sum of ``conv_id:turn`` names; dropped ones are marked ``absent``."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"), (F.col("kind") == 0).alias("absent"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audits(damaged(table(spark, sf_dir, "conversations")))


def op13_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = url_reputation.outcomes_of(table(spark, sf_dir, "labels"))
    return url_reputation.judge(table(spark, sf_dir, "pages"), outcomes).select(
        "page_id", "host", "path", "rule", "verdict", "n_labelled")


QUERIES = {f.__name__: f for f in (
    op1_katz_scores, op2_benchmark_leaks, op3_packing, op4_secret_spans, op5_language_id, op6_license_lines,
    op7_token_store, op8_quality_verdicts, op9_ngram_join, op10_toxicity, op11_hard_negatives,
    op12_conversation_repair, op13_url_verdicts)}

ORACLES: dict = {"op11_hard_negatives": OP11, "op13_url_verdicts": OP13}
