"""Training-log tables (W1-W5): series, moving average, per-epoch views, leaderboard.

A training log is a table of records ``(run, step, epoch, loss, eval_loss,
eval_accuracy, ...)`` with missing keys as nulls (the ``log_history`` list of
the reference, exploded).  Record order within a run is given by ``order_cols``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope.plans.ordering import exact_part, indexed_scan, part_ids, part_value

SERIES = ("loss", "eval_loss", "eval_accuracy", "eval_rougeL")
WINDOW_DIVISOR = 100
ROUND = 6


def training_rows(log: DataFrame) -> DataFrame:
    """Training records: ``loss`` present, ``eval_loss`` absent, ``epoch`` present."""
    return log.where(F.col("loss").isNotNull() & F.col("eval_loss").isNull()
                     & F.col("epoch").isNotNull())


def series(log: DataFrame, run_col: str = "run", step_col: str = "step") -> DataFrame:
    """Long form ``(run, step, series, value)`` by key presence."""
    parts = F.array(*[F.struct(F.lit(s).alias("series"), F.col(s).cast("double").alias("value"))
                      for s in SERIES if s in log.columns])
    return (log.select(run_col, step_col, F.explode(parts).alias("x"))
            .where(F.col("x.value").isNotNull())
            .select(run_col, step_col, F.col("x.series").alias("series"),
                    F.col("x.value").alias("value")))


def moving_average(log: DataFrame, run_col: str, order_cols: Sequence[str],
                   value_col: str = "loss", member: Column | None = None) -> DataFrame:
    """Trailing mean over series rows ``i-w .. i``, ``w = max(1, n // 100)`` per run.

    ``member`` selects the rows of the series (e.g. training records) inside a
    larger log; ``step`` is the 1-based position of the record in the whole
    log.  One ordered scan yields the log position, the series position and
    exact prefix sums (one DECIMAL sum per 12 decades that occur, so that losses of
    any size keep all their digits); the window mean is ``(S[i] - S[i-w-1]) / rows`` with
    ``S[i-w-1]`` fetched by an equi-join on ``(run, i)``.  No window ever
    spans a whole run.
    """
    m = member if member is not None else F.lit(True)
    v = F.col(value_col)
    kinds = {"_nan": F.isnan(v), "_pinf": v == float("inf"), "_ninf": v == float("-inf")}
    parts = {f"_v{n}": k for n, k in enumerate(part_ids(log.where(m), value_col))}
    prepared = log.select(run_col, *order_cols, value_col,
                          F.when(m, F.lit(1)).otherwise(F.lit(0)).alias("_in"),
                          *[F.when(m, exact_part(v, k)).otherwise(F.lit(0)).alias(name)
                            for name, k in parts.items()],
                          *[F.when(m & k, F.lit(1)).otherwise(F.lit(0)).alias(name)
                            for name, k in kinds.items()])
    summed = [*parts, *kinds]
    scanned = indexed_scan(prepared, run_col, order_cols, ["_in", *summed])
    rows = scanned.where(F.col("_in") == 1).select(
        run_col, *order_cols, value_col, (F.col("idx") + 1).alias("step"),
        (F.col("cum__in") - 1).cast("bigint").alias("i"),
        F.col("tot__in").cast("bigint").alias("n"),
        *[F.col(f"cum_{name}").alias(f"c{name}") for name in summed])
    w = F.greatest(F.lit(1), F.floor(F.col("n") / WINDOW_DIVISOR))
    rows = rows.withColumn("w", w)
    prev = rows.select(F.col(run_col).alias("_r"), F.col("i").alias("_pi"),
                       *[F.col(f"c{name}").alias(f"_p{name}") for name in summed])
    joined = rows.join(prev, (F.col(run_col) == F.col("_r"))
                       & (F.col("i") - F.col("w") - 1 == F.col("_pi")), "left")
    n_rows = F.col("i") - F.greatest(F.lit(0), F.col("i") - F.col("w")) + 1
    inside = {name: F.col(f"c{name}") - F.coalesce(F.col(f"_p{name}"), F.lit(0)) for name in summed}
    in_window = {name: inside[name] > 0 for name in kinds}
    # Smallest part first; the usual case is one part, and then one rounding.
    mean = F.lit(0.0)
    for name, k in parts.items():
        mean = mean + part_value(inside[name] / n_rows, k)
    mean = F.round(mean, ROUND)
    # Non-finite losses behave as in a Python sum: NaN, or +inf and -inf together,
    # give NaN; only +inf (only -inf) gives +inf (-inf).
    smoothed = (F.when(in_window["_nan"] | (in_window["_pinf"] & in_window["_ninf"]),
                       F.lit(float("nan")))
                .when(in_window["_pinf"], F.lit(float("inf")))
                .when(in_window["_ninf"], F.lit(float("-inf")))
                .otherwise(mean))
    return joined.select(
        run_col, *order_cols, "step", value_col, F.col("w").cast("int").alias("window"),
        smoothed.alias("smoothed"))


def epoch_mean_loss(train: DataFrame, run_col: str = "run") -> DataFrame:
    """Mean training loss per ``ceil(epoch)``."""
    return train.groupBy(run_col, F.ceil("epoch").cast("int").alias("epoch")).agg(
        F.round(F.avg("loss"), ROUND).alias("mean_loss"))


def epoch_last_eval(log: DataFrame, run_col: str, order_cols: str | Sequence[str],
                    value_col: str = "eval_loss") -> DataFrame:
    """Per ``round(epoch)`` (half-even), the value of the latest record.

    ``order_cols`` together are unique per record (a step number, or a timestamp and an id).
    """
    keys = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    evals = log.where(F.col(value_col).isNotNull() & F.col("epoch").isNotNull())
    return evals.groupBy(run_col, F.bround("epoch", 0).cast("int").alias("epoch")).agg(
        F.max_by(F.col(value_col), F.struct(*keys)).alias(value_col))


def leaderboard(scores: DataFrame, run_col: str, score_col: str, pos_col: str) -> DataFrame:
    """W5 ranking: highest score first, ties in listing order, unscored last."""
    return scores.orderBy(F.col(score_col).desc_nulls_last(), F.col(pos_col).asc())


def pick_best(scores: DataFrame, run_col: str, score_col: str, pos_col: str,
              explicit: str | None = None, fallback: str | None = None) -> DataFrame:
    """One row - the explicit run if given, else the best run, else the fallback."""
    spark = scores.sparkSession
    if explicit is not None:
        return spark.createDataFrame([(explicit, None)], f"{run_col} string, {score_col} double")
    best = leaderboard(scores, run_col, score_col, pos_col).limit(1).select(
        F.col(run_col).cast("string").alias(run_col), F.col(score_col).cast("double"),
        F.lit(0).alias("_prio"))
    if fallback is None:
        return best.drop("_prio")
    fb = spark.createDataFrame([(fallback, None, 1)], f"{run_col} string, {score_col} double, _prio int")
    # The fallback only wins when there is no run at all.
    return best.unionByName(fb).orderBy("_prio").limit(1).drop("_prio")
