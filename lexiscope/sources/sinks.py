"""Sinks (K1-K3): tables, per-article JSON reports, run metrics.

Every sink writes a folder of part files (one per task), never a single
driver-side file, so output size is not bounded by one machine.
"""

from __future__ import annotations

import os
import uuid

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.session import cut_lineage


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, encoding: str = "UTF-8",
                header: bool = True) -> str:
    """K1: standardised / stitched / pairs / tag lists / per-row results."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = (w.option("header", str(header).lower()).option("quote", '"').option("escape", '"')
             .option("encoding", encoding)
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
        w.csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_bucketed_table(df: DataFrame, table: str, key: str = "doc_id", buckets: int = 512,
                         mode: str = "overwrite") -> str:
    """K1 for the corpus: a catalog table bucketed and sorted by ``key``.

    Jobs that aggregate or join per document (tagging, the report's fan-in)
    then read data already hash-partitioned by the key: Spark plans them with
    no exchange at all (only the bounded lookup is broadcast).
    """
    df.write.bucketBy(buckets, key).sortBy(key).mode(mode).saveAsTable(table)
    return table


def _write_text_files(root: str, folders: int, run: str):
    """Writer of a task's rows ``part, number, value`` (bytes) as files below ``root``, a folder all machines mount."""
    def write(rows) -> None:
        made: set[str] = set()
        attempt = TaskContext.get().taskAttemptId()
        for part, number, value in rows:
            folder = f"{root}/folder={number % folders}"
            if folder not in made:
                os.makedirs(folder, exist_ok=True)
                made.add(folder)
            # Whole under its name or not at all, also if two attempts of the task write it; readers skip names with ``_``.
            begun = f"{folder}/_{attempt}"
            with open(begun, "wb") as f:
                f.write(value + b"\n")
            os.replace(begun, f"{folder}/part-{part:05d}-{run}.c{number:06d}.txt")

    return write


def write_text_corpus(docs: DataFrame, path: str, folders: int = 64, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One ``.txt`` file per row (a null text: an empty one) in at most ``folders`` folders below ``path/files``.

    Returns the manifest, kept at ``path/manifest``: ``id, part, number, n_bytes``; ``part`` and ``number`` stand in each
    file's name (see :func:`lexiscope.sources.readers.corpus_places`), so the id needs no folder of its own.  The rows are
    cut from their lineage first: a task that runs again writes the same rows under the same names.

    Where ``path`` is a mounted folder, the tasks create the files themselves: Hadoop's local file system starts a ``chmod``
    process several times a file.  In other stores Spark's writer does; there a task may hold a million rows at most, a
    bound of that writer, which stops beyond it.
    """
    spark = docs.sparkSession
    place = F.monotonically_increasing_id()  # task in the upper bits, row within the task in the lower 33
    fixed = cut_lineage(docs.select(id_col, F.col(text_col).alias("value")))
    rows = fixed.withColumn("part", F.shiftrightunsigned(place, 33).cast("int")).withColumn(
        "number", place.bitwiseAND((1 << 33) - 1))
    rows.select(id_col, "part", "number", F.coalesce(F.octet_length("value"), F.lit(0)).cast("long").alias("n_bytes")
                ).write.mode("overwrite").parquet(f"{path}/manifest")
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/files")
    store = files.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() == "file":
        store.delete(files, True)
        store.mkdirs(files)
        text = F.coalesce(F.col("value"), F.lit("")).cast("binary")
        rows.select("part", "number", text).foreachPartition(
            _write_text_files(files.toUri().getPath(), folders, uuid.uuid4().hex))
    else:
        # All rows of a task go to one folder, in their order: the writer finds them sorted as it needs them.
        (rows.withColumn("folder", F.col("part") % folders).sortWithinPartitions("folder", "number").select("folder", "value")
         .write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("folder").text(f"{path}/files"))
    return spark.read.parquet(f"{path}/manifest")


def tag_list_literal(col):
    """Tag list as the legacy Python-literal text (``['cns', 'positive']``): single quotes, or double ones around a
    text that holds only single ones; backslashes, the quote and line ends are escaped."""
    def quoted(x):
        mark = F.when(F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"')), F.lit('"')).otherwise(F.lit("'"))
        body = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        for raw, name in (("\n", "n"), ("\r", "r"), ("\t", "t")):
            body = F.replace(body, F.lit(raw), F.lit(f"\\{name}"))
        return F.concat(mark, F.replace(body, mark, F.concat(F.lit("\\"), mark)), mark)

    return F.concat(F.lit("["), F.array_join(F.transform(col, quoted), ", "), F.lit("]"))


def write_reports_json(nested: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K2: one JSON object per article (JSON lines); nulls kept, non-ASCII kept."""
    nested.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def write_run_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K3: best checkpoint / metric + validation{} + test{} per run, as JSON lines."""
    metrics.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


#: Folder of the checkpoints that hold the records of many runs together.
ALL_RUNS = "all-runs"


def write_training_log(log: DataFrame, root: str, run_col: str, checkpoint: int) -> str:
    """A checkpoint of every run of ``log``: its records as JSON lines below ``<root>/all-runs/checkpoint=<n>``.

    Each record names its run, so the number of files follows the tasks that write, not the runs.
    """
    record = F.to_json(F.struct(F.col(run_col).cast("string").alias("run"), *[c for c in log.columns if c != run_col]))
    log.select(record.alias("value")).write.mode("append").text(f"{root.rstrip('/')}/{ALL_RUNS}/checkpoint={checkpoint}")
    return root
