"""Evaluation tables (A1-A5): counts, class weights, confusion matrix, metrics.

Everything reduces the data first with one ``groupBy(true, pred)`` (map-side
partial aggregation; at most 9 groups for three classes).  The formulas then
run on that tiny table, so no step ever needs ``collect``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELS = ("positive", "negative", "neutral")  # fixed display order


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A1: rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A2: balanced weights ``n / (k * n_c)`` over the classes present."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(
        F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy()  # over <= k rows after the aggregate
    return counts.select(
        label_col, "n_c",
        (F.sum("n_c").over(everything)
         / (F.count(F.lit(1)).over(everything) * F.col("n_c"))).alias("weight"))


def pair_counts(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """Rows with a null side are dropped, then counted per (true, pred)."""
    return (df.where(F.col(true_col).isNotNull() & F.col(pred_col).isNotNull())
            .groupBy(F.col(true_col).alias("true_label"), F.col(pred_col).alias("pred_label"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(spark: SparkSession, df: DataFrame, true_col: str, pred_col: str,
                     labels: Sequence[str] = LABELS) -> DataFrame:
    """A3: long form ``(true_label, pred_label, n)`` over the fixed label grid, zeros kept."""
    grid = spark.createDataFrame(
        [(t, p, i * len(labels) + j) for i, t in enumerate(labels) for j, p in enumerate(labels)],
        T.StructType([T.StructField("true_label", T.StringType()),
                      T.StructField("pred_label", T.StringType()),
                      T.StructField("cell", T.IntegerType())]))
    # Restricted to the grid's labels, the counts have at most len(labels)^2
    # rows, so broadcasting them (the right side of the left join) is bounded.
    counts = pair_counts(df, true_col, pred_col).where(
        F.col("true_label").isin(*labels) & F.col("pred_label").isin(*labels))
    return (grid.join(F.broadcast(counts), ["true_label", "pred_label"], "left")
            .select("true_label", "pred_label", F.coalesce("n", F.lit(0)).alias("n"), "cell"))


def classification_metrics(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """A4: accuracy and support-weighted precision / recall / F1 (0 when undefined).

    Labels are those seen on either side; F1 per class is ``2tp / (2tp + fp + fn)``.
    """
    pc = pair_counts(df, true_col, pred_col)
    # Each (true, pred, n) cell adds n to the support of ``true``, to the
    # predictions of ``pred`` and, on the diagonal, to the hits of ``true``:
    # one aggregate over the exploded cells, no joins.
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(zero)
    roles = F.array(
        F.struct(F.col("true_label").alias("label"), F.col("n").alias("s"), zero.alias("p"),
                 hit.alias("t")),
        F.struct(F.col("pred_label").alias("label"), zero.alias("s"), F.col("n").alias("p"),
                 zero.alias("t")))
    per = (pc.select(F.explode(roles).alias("r"))
           .groupBy(F.col("r.label").alias("label"))
           .agg(F.sum("r.s").alias("support"), F.sum("r.p").alias("predicted"),
                F.sum("r.t").alias("tp")))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1d = 2 * F.col("tp") + (F.col("predicted") - F.col("tp")) + (F.col("support") - F.col("tp"))
    f1 = F.when(f1d > 0, 2 * F.col("tp") / f1d).otherwise(F.lit(0.0))
    agg = per.agg(
        F.sum("support").alias("n"),
        F.sum("tp").alias("correct"),
        F.sum(prec * F.col("support")).alias("wp"),
        F.sum(rec * F.col("support")).alias("wr"),
        F.sum(f1 * F.col("support")).alias("wf"),
    )
    return agg.select(
        F.col("n").cast("bigint").alias("n"),
        F.round(F.col("correct") / F.col("n"), 6).alias("accuracy"),
        F.round(F.col("wp") / F.col("n"), 6).alias("precision"),
        F.round(F.col("wr") / F.col("n"), 6).alias("recall"),
        F.round(F.col("wf") / F.col("n"), 6).alias("f1"),
    )


def per_row_results(signals: DataFrame, truth: DataFrame, id_col: str = "doc_id",
                    true_col: str = "label") -> DataFrame:
    """A5: prediction + confidence + bias shares + flag + true label, per row."""
    return signals.join(truth.select(id_col, F.col(true_col).alias("true_sentiment")), id_col)
