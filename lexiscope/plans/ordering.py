"""Row indices and running sums within a group, without one task per group.

``Window.partitionBy(group).orderBy(...)`` puts a whole group in one task; a
group holding a third of the data would serialise the job.  Instead:

1. range-partition on ``(group, order...)``: a hot group spans many partitions;
2. number rows and take running sums per ``(partition, group)`` (bounded by
   the partition size);
3. total each ``(partition, group)`` slice into a small table, and turn it
   into per-slice offsets with a window over that small table;
4. add the offsets back (equi-join on ``(partition, group)``).

The range-partitioned input is checkpointed (reliable, in the shared
checkpoint folder) before it branches, so every branch and every recompute
sees the same slice ids.
Running sums of integers and DECIMALs are exact, so a difference of two
prefix sums (a moving window) has no cancellation error.  Doubles of any
magnitude are first split by :func:`exact_parts`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.session import cut_lineage

#: Decades of one part: ``10**(12 k - 5) <= |v| < 10**(12 k + 7)`` belongs to part ``k``.
PART_DECADES, PART_FIRST = 12, -5
#: A part in units of ``10**(12 k)``: 7 integer digits and the at most 17 digits of a double,
#: with room for the sum of 10**10 rows.
PART_TYPE = "decimal(38,21)"


def _magnitude(c: Column) -> tuple[Column, Column]:
    """Shortest decimal form of a finite double: its digits and its power of ten."""
    pieces = F.split(F.format_string("%.16e", c), "e")
    return pieces[0], pieces[1].cast("int")


def part_ids(df: DataFrame, c: str) -> list[int]:
    """The parts that occur in the finite values of ``c``: at most 53, as doubles end at 1e308."""
    v = F.col(c)
    finite = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")) & (v != 0))
    _, power = _magnitude(v)
    rows = finite.select(F.floor((power - PART_FIRST) / PART_DECADES).cast("int").alias("k")).distinct().collect()
    return sorted(r.k for r in rows)


def exact_part(c: Column, k: int) -> Column:
    """``c`` in units of ``10**(12 k)`` as DECIMAL where it belongs to part ``k``, else 0.

    Null, NaN and infinities count as 0; the caller tracks them.  No finite value loses a digit."""
    digits, power = _magnitude(c)
    finite = c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) & (c != 0)
    belongs = finite & (F.floor((power - PART_FIRST) / PART_DECADES) == k)
    shifted = F.concat(digits, F.lit("E"), (power - PART_DECADES * k).cast("string"))
    return F.when(belongs, shifted.try_cast(PART_TYPE)).otherwise(F.lit(0).cast(PART_TYPE))


def part_value(total: Column, k: int) -> Column:
    """A sum of part ``k`` as a double; powers of ten below 1 divide, as they are no exact doubles."""
    value, power = total.cast("double"), PART_DECADES * k
    near = min(abs(power), 300)  # 10**312 and 10**324 are no doubles
    for step in (near, abs(power) - near):
        if step:
            value = value * F.lit(10.0 ** step) if power > 0 else value / F.lit(10.0 ** step)
    return value


def indexed_scan(df: DataFrame, group_col: str, order_cols: Sequence[str],
                 sum_cols: Sequence[str] = (), num_partitions: int | None = None,
                 checkpoint: bool = False) -> DataFrame:
    """Adds ``idx`` (0-based position in the group), ``group_size`` and, per
    ``c`` in ``sum_cols``, ``cum_<c>`` = inclusive running sum and ``tot_<c>``
    = group total, of the type that Spark's ``sum`` gives (nulls count as 0).
    ``checkpoint`` stores the result too, for callers that read it often."""
    def number(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))


    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The partition id is materialised once (reliable checkpoint): every branch
    # below reads the same ids, and a recompute after executor loss cannot
    # assign rows to different slices.
    ranged = cut_lineage(df.repartitionByRange(n, group_col, *order_cols)
                         .withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", group_col).orderBy(*order_cols)
    wcum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*", (F.row_number().over(w) - 1).alias("_lidx"),
        *[F.sum(number(c)).over(wcum).alias(f"_lcum_{c}") for c in sum_cols])
    totals = local.groupBy("_pid", group_col).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(number(c)).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", group_col,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(group_col)).alias("group_size"),
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
          for c in sum_cols],
        *[F.sum(f"_t_{c}").over(Window.partitionBy(group_col)).alias(f"tot_{c}")
          for c in sum_cols])
    out = local.join(offsets, ["_pid", group_col]).select(
        *df.columns,
        (F.col("_off") + F.col("_lidx")).alias("idx"),
        "group_size",
        *[(F.col(f"_off_{c}") + F.col(f"_lcum_{c}")).alias(f"cum_{c}")
          for c in sum_cols],
        *[f"tot_{c}" for c in sum_cols])
    return cut_lineage(out) if checkpoint else out
