"""Seeded shuffles, samples and splits (O1-O6), independent of partitioning.

Every row gets ``h = first 8 hex digits of md5(seed || id)`` (a 32-bit value,
identical in Spark and DuckDB).  Threshold splits compare ``h`` with a
fraction of 2^32 and never shuffle.  Exact per-class quotas (O5) need ranks
inside each class; instead of a window over a whole class (one task per
class), rows are counted per ``(class, h >> 16)`` bucket, running sums are
taken on that small table, and only the rows of the (at most two) buckets a
quota boundary falls into are ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.functions.hashing import seeded_hash
from lexiscope.session import cut_lineage

HASH_SPACE = 1 << 32
BUCKET_SHIFT = 16  # 2^16 buckets per class
DEFAULT_SEED = 42
MAX_BUCKET_TABLE_ROWS = 5_000_000


def with_hash(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED, name: str = "h") -> DataFrame:
    return df.withColumn(name, seeded_hash(F.col(id_col), seed))


def seeded_shuffle(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """O1: deterministic order by ``(h, id)`` (range-partitioned global sort)."""
    return with_hash(df, id_col, seed).orderBy("h", id_col)


def seeded_subset(df: DataFrame, id_col: str, n: int = 1500, seed: int = DEFAULT_SEED) -> DataFrame:
    """O2: first ``n`` rows of the seeded order - a top-k, not a full sort."""
    return with_hash(df, id_col, seed).orderBy("h", id_col).limit(n)


def hash_fraction(h: Column) -> Column:
    return h / F.lit(float(HASH_SPACE))


def fraction_sample(df: DataFrame, id_col: str, fraction: float,
                    seed: int = DEFAULT_SEED) -> DataFrame:
    """O3: rows whose hash falls below ``fraction`` of the hash space."""
    return df.where(hash_fraction(seeded_hash(F.col(id_col), seed)) < fraction)


def thresholds(weights: dict[str, float]) -> list[tuple[str, float | None]]:
    """Cumulative upper bounds per split (the last split takes the rest: ``None``)."""
    total = sum(weights.values())
    out, acc = [], 0.0
    items = list(weights.items())
    for i, (split, w) in enumerate(items):
        acc += w / total
        out.append((split, None if i == len(items) - 1 else acc))
    return out


def threshold_split(df: DataFrame, id_col: str, weights: dict[str, float],
                    seed: int = DEFAULT_SEED, name: str = "split") -> DataFrame:
    """Split names by cumulative hash thresholds (narrow, no shuffle)."""
    u = hash_fraction(seeded_hash(F.col(id_col), seed))
    expr = None
    for split, bound in thresholds(weights):
        if bound is None:
            expr = F.lit(split) if expr is None else expr.otherwise(F.lit(split))
        else:
            expr = (F.when(u < bound, F.lit(split)) if expr is None
                    else expr.when(u < bound, F.lit(split)))
    return df.withColumn(name, expr)


TRAIN_TEST = {"train": 0.8, "test": 0.2}
TRAIN_VAL_TEST = {"train": 0.8, "validation": 0.1, "test": 0.1}


def train_test(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Unstratified 80/20."""
    return threshold_split(df, id_col, TRAIN_TEST, seed)


def train_val_test(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """80/10/10."""
    return threshold_split(df, id_col, TRAIN_VAL_TEST, seed)


def _split_of_rank(r: Column, n_test: Column, n_val: Column) -> Column:
    return (F.when(r < n_test, F.lit("test")).when(r < n_test + n_val, F.lit("validation"))
            .otherwise(F.lit("train")))


def stratified_split(df: DataFrame, id_col: str, label_col: str, test_size: float = 0.2,
                     val_size: float = 0.2, seed: int = DEFAULT_SEED,
                     name: str = "split") -> DataFrame:
    """Exact per-class quotas: test = ceil(t*n_c), validation = ceil(v*(n_c - test)).

    Rows are ranked in ``(h, id)`` order within their class.  Only the small
    per-bucket count table is windowed; boundary buckets are ranked with a
    window over ``(class, bucket)``, which is bounded by the bucket size.
    """
    hashed = with_hash(df, id_col, seed).withColumn("b", F.shiftright("h", BUCKET_SHIFT))
    buckets = hashed.groupBy(label_col, "b").agg(F.count(F.lit(1)).alias("cnt"))
    per_class = Window.partitionBy(label_col)
    ordered = per_class.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (buckets
               .withColumn("n_c", F.sum("cnt").over(per_class))
               .withColumn("start", F.coalesce(F.sum("cnt").over(ordered), F.lit(0)))
               .withColumn("n_test", F.ceil(F.col("n_c") * test_size).cast("bigint"))
               .withColumn("n_val", F.ceil((F.col("n_c") - F.col("n_test")) * val_size)
                           .cast("bigint")))
    first = _split_of_rank(F.col("start"), F.col("n_test"), F.col("n_val"))
    last = _split_of_rank(F.col("start") + F.col("cnt") - 1, F.col("n_test"), F.col("n_val"))
    buckets = buckets.withColumn("whole", F.when(first == last, first))
    # Materialise the small table once (reliable checkpoint), so counting it
    # does not recompute it; broadcast only under the checked bound.
    buckets = cut_lineage(buckets.select(
        F.col(label_col).alias("_lbl"), F.col("b").alias("_b"),
        "start", "n_test", "n_val", "whole"))
    n_rows = buckets.count()
    side = F.broadcast(buckets) if n_rows <= MAX_BUCKET_TABLE_ROWS else buckets
    cond = F.col(label_col).eqNullSafe(F.col("_lbl")) & (F.col("b") == F.col("_b"))
    joined = hashed.join(side, cond).drop("_lbl", "_b")
    simple = joined.where(F.col("whole").isNotNull()).withColumn(name, F.col("whole"))
    in_bucket = Window.partitionBy(label_col, "b").orderBy("h", id_col)
    edge = (joined.where(F.col("whole").isNull())
            .withColumn("r", F.col("start") + F.row_number().over(in_bucket) - 1)
            .withColumn(name, _split_of_rank(F.col("r"), F.col("n_test"), F.col("n_val")))
            .drop("r"))
    cols = df.columns + [name]
    return simple.select(*cols).unionByName(edge.select(*cols))


def expected_quotas(n: int, test_size: float = 0.2, val_size: float = 0.2) -> tuple[int, int, int]:
    """(train, validation, test) sizes of :func:`stratified_split` for a class of ``n`` rows."""
    n_test = math.ceil(n * test_size)
    n_val = math.ceil((n - n_test) * val_size)
    return n - n_test - n_val, n_val, n_test
