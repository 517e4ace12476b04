"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiscope.session import ensure_checkpoint_dir, scratch_path, ship_package

#: ASCII white space, the only separator of words in these operators.
WHITE = " \t\n\x0b\f\r"
WHITE_CLASS = "[\\x20\\x09-\\x0D]+"


def crc_mod(col: str, m: int) -> Column:
    """``crc32`` of the column's text modulo ``m`` (null for a null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


def words_of(text: Column) -> Column:
    """Words of a text (runs of non-white characters); an empty array for null or blank."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_CLASS))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read again:
    lineage ends there, and a lost executor costs no earlier work."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> None:
    """Workers can import the package and the checkpoint folder is known."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    # Whole texts go to Python workers: smaller batches, unless the submitter has chosen a size.
    if not spark.sparkContext.getConf().contains(BATCH_ROWS):
        spark.conf.set(BATCH_ROWS, "2000")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_sample(rows: DataFrame, group: str, most: dict | int, groups: DataFrame | None = None) -> DataFrame:
    """At most ``most`` rows with different texts of each ``group``: ``doc_id, text, group`` (those whose text
    hashes come first).  ``groups`` (``doc_id``, ``group``; one row an id) gives the group where ``rows`` doesn't.

    Only ids and hashes are joined and compared until the sample is known; texts never move for it.
    """
    light = rows.select("doc_id", F.xxhash64("text").alias("h"), *([] if groups is not None else [group]))
    if groups is not None:
        light = light.join(groups, "doc_id")
    light = written(light.groupBy(group, "h").agg(F.min("doc_id").alias("doc_id")), "sample-hashes")
    share = light.groupBy(group).agg(F.count(F.lit(1)).alias("n"))  # one row for each group
    if isinstance(most, dict):
        limit = F.coalesce(*[F.when(F.col(group) == k, n) for k, n in most.items()], F.lit(0))
    else:
        limit = F.lit(most)
    thin = light.join(F.broadcast(share), group).where(F.expr("pmod(h, 1048576)") * F.col("n") < limit * 2 * 1048576.0)
    first = Window.partitionBy(group).orderBy(F.expr("pmod(h, 1048576)"), "h")
    picks = thin.select(group, "h", "doc_id", F.row_number().over(first).alias("r")).where(F.col("r") <= limit)
    picks = written(picks.select(F.col("doc_id").alias("doc_id_"), F.col("h").alias("h_"),
                                 F.col(group).alias("group_")), "sample")
    found = rows.join(F.broadcast(picks), (rows["doc_id"] == picks["doc_id_"]) & (F.xxhash64(rows["text"]) == picks["h_"]))
    return found.dropDuplicates(["group_", "h_"]).select("doc_id", "text", F.col("group_").alias(group))


#: Groups with more than 1/HOT of the rows (at most HOT of them) are broadcast.
HOT = 256


def find_by(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """``left`` with the row of ``right`` (one for each key) of its key; ``right[weight]`` counts the rows of ``left``
    with that key.  Keys with over 1/HOT of the rows, at most HOT of them, are broadcast."""
    total = right.agg(F.sum(weight)).first()[0] or 0
    often = F.col(weight) * HOT > total
    hot, cold = F.broadcast(right.where(often)), right.where(~often)
    beside = left.join(F.broadcast(right.where(often).select(key)), key, "left_anti")
    return left.join(hot, key).unionByName(beside.join(cold, key))
