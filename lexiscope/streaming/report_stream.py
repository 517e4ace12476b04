"""Reliability reports over an unbounded text source (stateless).

Each micro-batch runs the *same* batch plan as the report job (explode +
broadcast lookup + per-document aggregate).  Every document arrives whole in
one micro-batch, so the per-document aggregate is complete inside the batch
and no state store is needed.  Output goes to ``<sink>/batch_id=<n>`` with
overwrite, so a retried micro-batch replaces its own output (idempotent).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexiscope.operators import lexicon as lx
from lexiscope.operators import report as rp

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("text", T.StringType())])


def table_source(path: str) -> str:
    """A pattern that only the table at ``path`` matches.  A stream takes a folder of files as its source, and a
    table of a single file by a pattern alone; this one serves both."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}" if folder or path.startswith("/") else f"{{{name}}}"


def start_report_stream(spark: SparkSession, source: str, sink: str, checkpoint: str,
                        lookup: lx.Lookup, schema: T.StructType = DOC_SCHEMA,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        processing_time: str | None = None,
                        path_glob: str | None = None) -> StreamingQuery:
    """Start the stream over the parquet files of folder ``source`` (optionally
    only those matching ``path_glob``); ``available_now`` processes what is
    there and stops."""
    reader = spark.readStream.schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source).select("doc_id", "text")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        flat = rp.report_table(batch, lookup)
        (flat.withColumn("reasons", F.array_join("reasons", ","))
         .write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_rowwise_report_stream(spark: SparkSession, source: str, sink: str, checkpoint: str,
                                lookup: lx.Lookup, schema: T.StructType = DOC_SCHEMA,
                                available_now: bool = True, path_glob: str | None = None,
                                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """R6 as a plain append-mode stream: every signal is a row function
    (row-wise tagging), so there is no join, no aggregate and no state; the
    file sink's log makes the output exactly-once.  A lookup beyond its broadcast bound is joined in each
    micro-batch instead (:func:`start_report_stream`)."""
    if not lookup.broadcast:
        return start_report_stream(spark, source, sink, checkpoint, lookup, schema, available_now,
                                   max_files_per_trigger, path_glob=path_glob)
    reader = spark.readStream.schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source).select("doc_id", "text")
    flat = rp.report_table_rowwise(stream, lookup).withColumn("reasons", F.array_join("reasons", ","))
    writer = (flat.writeStream.format("parquet").outputMode("append")
              .option("path", sink).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# ---- a dictionary that changes while the stream runs ----------------------------

VERSION_SCHEMA = T.StructType([T.StructField("version", T.LongType())])


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of version records under ``path``; none where nothing is written yet."""
    try:
        return spark.read.schema(VERSION_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSION_SCHEMA)


def _record(spark: SparkSession, path: str, version: int) -> None:
    """One file, so it is there as a whole or not at all."""
    spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("overwrite").parquet(path)


def newest_version(spark: SparkSession, root: str) -> int | None:
    """The greatest published version of the dictionary under ``root``, None before the first."""
    return _versions(spark, f"{root.rstrip('/')}/published/*").agg(F.max("version").alias("v")).first()["v"]


def publish_dictionary(dictionary: DataFrame, root: str) -> int:
    """Write ``dictionary`` as the next version under ``root`` and return its number (1, 2, ...).

    Streams see a version only once its words are written as a whole: the record that publishes it comes last.  A version
    never changes afterwards.  One publisher at a time.
    """
    spark, root = dictionary.sparkSession, root.rstrip("/")
    version = (newest_version(spark, root) or 0) + 1
    lx.project_dictionary(dictionary).write.mode("overwrite").parquet(f"{root}/words/{version}")
    _record(spark, f"{root}/published/{version}", version)
    return version


def start_versioned_report_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, dictionaries: str,
                                  records: str, schema: T.StructType = DOC_SCHEMA, available_now: bool = True,
                                  max_files_per_trigger: int | None = None, processing_time: str | None = None,
                                  stopword_mode: str = "before_lookup") -> StreamingQuery:
    """R6 against the dictionary of :func:`publish_dictionary`, whose newest version each micro-batch takes when it begins.

    The batch's version is written to ``records`` before its first row is tagged, and a batch that runs again (after a
    lost driver) takes the version of its record, so a replay tags alike whatever was published in between.  Rows carry
    ``dictionary_version``.  A batch that begins before the first version stops the stream.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source).select("doc_id", "text")
    root, kept = dictionaries.rstrip("/"), {}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session, place = batch.sparkSession, f"{records.rstrip('/')}/batch_id={batch_id}"
        row = _versions(session, place).first()
        version = row["version"] if row else newest_version(session, root)
        if version is None:
            raise ValueError(f"no dictionary is published under {root}")
        if not row:
            _record(session, place, version)
        if version not in kept:  # the last version's lookup serves the next batches
            kept.clear()
            kept[version] = lx.prepare_lookup(session.read.parquet(f"{root}/words/{version}"), stopword_mode)
        flat = rp.report_table(batch, kept[version])
        (flat.withColumn("reasons", F.array_join("reasons", ",")).withColumn("dictionary_version", F.lit(version).cast("long"))
         .write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_stream_output(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("batch_id")
