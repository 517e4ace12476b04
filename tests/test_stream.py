"""The streaming report equals the batch report and keeps no state."""

import tempfile

from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.operators import lexicon as lx
from lexiscope.operators import report as rp
from lexiscope.streaming.report_stream import read_stream_output, start_report_stream


def test_stream_equals_batch(spark, sf):
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    sink, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp()
    q = start_report_stream(spark, sf, sink, ckpt, lk, path_glob="documents.parquet",
                            max_files_per_trigger=1)
    q.awaitTermination()
    progress = q.lastProgress or {}
    assert progress.get("stateOperators", []) == []
    streamed = read_stream_output(spark, sink)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    batch = rp.report_table(docs, lk).withColumn("reasons", F.array_join("reasons", ","))
    cols = batch.columns
    assert streamed.select(*cols).exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed.select(*cols)).count() == 0


def test_rowwise_stream_equals_batch(spark, sf):
    from lexiscope.streaming.report_stream import start_rowwise_report_stream
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    sink, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp()
    q = start_rowwise_report_stream(spark, sf, sink, ckpt, lk, path_glob="documents.parquet")
    q.awaitTermination()
    assert (q.lastProgress or {}).get("stateOperators", []) == []
    streamed = spark.read.parquet(sink)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    batch = rp.report_table(docs, lk).withColumn("reasons", F.array_join("reasons", ","))
    cols = batch.columns
    assert streamed.select(*cols).exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed.select(*cols)).count() == 0


def test_streams_are_exactly_once_across_restarts(spark, sf):
    """New files after a restart are processed once; processed files are not redone."""
    import os

    from lexiscope.streaming.report_stream import start_rowwise_report_stream
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    parts = [docs.where(F.col("doc_id") % 4 == k) for k in range(4)]  # four files, all rows
    batch = rp.report_table(docs, lk).withColumn("reasons", F.array_join("reasons", ","))
    cols = batch.columns
    for start in (start_report_stream, start_rowwise_report_stream):
        sink, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp()
        src_k = tempfile.mkdtemp()
        for k in (0, 1):
            parts[k].coalesce(1).write.parquet(os.path.join(src_k, f"p{k}"))
        # sources are folders of parquet files: read the files one level down
        q = start(spark, src_k + "/*", sink, ckpt, lk, max_files_per_trigger=1)
        q.awaitTermination()
        for k in (2, 3):
            parts[k].coalesce(1).write.parquet(os.path.join(src_k, f"p{k}"))
        q = start(spark, src_k + "/*", sink, ckpt, lk, max_files_per_trigger=1)
        q.awaitTermination()
        out = read_stream_output(spark, sink).select(*cols)
        assert out.count() == docs.count()
        assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_a_replayed_batch_keeps_its_dictionary(spark):
    """A batch whose commit is lost runs again after a new dictionary is published: it keeps the version of its record;
    the next batch takes the new one."""
    import os

    from lexiscope.streaming.report_stream import newest_version, publish_dictionary, start_versioned_report_stream
    src, sink, ckpt, words, records = (tempfile.mkdtemp() for _ in range(5))
    first = fixtures.fixture_dictionary(spark)
    second = first.withColumns({"positive": F.col("negative"), "negative": F.col("positive")})
    run = lambda: start_versioned_report_stream(spark, src + "/*", sink, ckpt, words, records).awaitTermination()
    arrive = lambda i, text: spark.createDataFrame([(i, text)], "doc_id long, text string").write.parquet(f"{src}/p{i}")
    labels = lambda: {r["doc_id"]: (r["dictionary_version"], r["lexicon_label"])
                      for r in read_stream_output(spark, sink).collect()}

    assert newest_version(spark, words) is None
    assert publish_dictionary(first, words) == 1
    arrive(0, "thing thing tion")
    run()
    assert labels() == {0: (1, "positive")}
    assert publish_dictionary(second, words) == 2
    for name in ("0", ".0.crc"):  # the driver is lost before the commit of batch 0
        if os.path.exists(os.path.join(ckpt, "commits", name)):
            os.remove(os.path.join(ckpt, "commits", name))
    arrive(1, "thing thing tion")
    run()
    assert labels() == {0: (1, "positive"), 1: (2, "negative")}


def test_an_unpublished_version_is_not_seen(spark):
    """Words without the record that publishes them (a publisher lost half-way) are passed over, then written anew."""
    from lexiscope.streaming.report_stream import newest_version, publish_dictionary
    words = tempfile.mkdtemp()
    d = fixtures.fixture_dictionary(spark)
    assert publish_dictionary(d, words) == 1
    lx.project_dictionary(d).limit(1).write.parquet(f"{words}/words/2")
    assert newest_version(spark, words) == 1
    assert publish_dictionary(d, words) == 2
    assert spark.read.parquet(f"{words}/words/2").count() == d.count()


def test_stream_queries_read_tables_of_one_file_and_of_many(spark, tmp_path):
    """``documents.parquet`` may be a file or a folder of part files, beside tables of other shapes."""
    import os

    from lexiscope.plans import queries as qs
    docs = spark.createDataFrame([(i, f"the thing is erin {'than' * (i % 3)} {i}.") for i in range(9)], "doc_id long, text string")
    docs.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "many" / "pages.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "raw"))
    os.makedirs(tmp_path / "one")
    part = next(f for f in os.listdir(tmp_path / "raw") if f.endswith(".parquet"))
    os.link(tmp_path / "raw" / part, tmp_path / "one" / "documents.parquet")
    spark.range(3).write.parquet(str(tmp_path / "one" / "pages.parquet"))
    want = sorted(r["doc_id"] for r in docs.collect())
    for query in (qs.q_report_stream, qs.q_report_stream_rowwise, qs.q_report_stream_derived):
        for kind in ("many", "one"):
            assert sorted(r["doc_id"] for r in query(spark, str(tmp_path / kind)).collect()) == want


def test_the_derived_stream_has_the_same_columns_beyond_the_broadcast_bound(spark, sf, monkeypatch):
    """Its lookup is joined in each micro-batch there; the folders of batches give no column."""
    from lexiscope.plans import queries as qs
    want = qs.q_report_stream_derived(spark, sf)
    prepare = lx.prepare_lookup
    monkeypatch.setattr(lx, "prepare_lookup", lambda d, *a, **k: prepare(d, *a, max_broadcast_rows=1, **k))
    got = qs.q_report_stream_derived(spark, sf)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
