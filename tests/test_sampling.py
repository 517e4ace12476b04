"""Splits: sizes, disjointness, partition independence, exact quotas."""

from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.operators import evaluate as ev
from lexiscope.operators import sampling as sm


def test_stratified_quotas_and_partition_independence(spark):
    ids = spark.range(0, 5000).select(F.col("id").alias("doc_id"),
                                      F.when(F.col("id") % 7 == 0, "a").when(F.col("id") % 3 == 0, "b")
                                      .otherwise("c").alias("label"))
    a = sm.stratified_split(ids, "doc_id", "label")
    b = sm.stratified_split(ids.repartition(13), "doc_id", "label")
    assert a.count() == 5000
    assert a.select("doc_id", "split").exceptAll(b.select("doc_id", "split")).count() == 0
    counts = {(r.label, r.split): r.n for r in a.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    n_c = {r.label: r.n for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    for lbl, n in n_c.items():
        tr, va, te = sm.expected_quotas(n)
        assert (counts.get((lbl, "train"), 0), counts.get((lbl, "validation"), 0),
                counts.get((lbl, "test"), 0)) == (tr, va, te)


def test_threshold_splits_are_disjoint_and_cover(spark):
    ids = spark.range(0, 20000).withColumnRenamed("id", "doc_id")
    s = sm.train_val_test(ids, "doc_id")
    c = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(c.values()) == 20000
    assert abs(c["train"] / 20000 - 0.8) < 0.02 and abs(c["test"] / 20000 - 0.1) < 0.02


def test_subset_is_topk_of_shuffle(spark):
    ids = spark.range(0, 3000).withColumnRenamed("id", "doc_id")
    top = [r.doc_id for r in sm.seeded_subset(ids, "doc_id", 100).collect()]
    full = [r.doc_id for r in sm.seeded_shuffle(ids, "doc_id").limit(100).collect()]
    assert top == full and len(set(top)) == 100


def test_hash_known_value(spark):
    from lexiscope.functions.hashing import hex_slice_int
    v = spark.range(1).select(hex_slice_int(F.md5(F.lit("x")), 1).alias("h")).first().h
    assert v == int("9dd4e461", 16)


def test_metrics_match_definition(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), ("c", None)]
    df = spark.createDataFrame(rows, "t string, p string")
    m = ev.classification_metrics(df, "t", "p").first()
    # a: tp1 fp1 fn1; b: tp2 fp1 fn0; c: tp0 fp0 fn1 -> supports 2, 2, 1
    p = (2 * 0.5 + 2 * (2 / 3) + 1 * 0) / 5
    r = (2 * 0.5 + 2 * 1 + 0) / 5
    f = (2 * 0.5 + 2 * 0.8 + 0) / 5
    assert m.n == 5 and m.accuracy == 0.6
    assert abs(m.precision - p) < 1e-6 and abs(m.recall - r) < 1e-6 and abs(m.f1 - f) < 1e-6
    cm = ev.confusion_matrix(spark, df.where(F.col("t") != "c").replace({"a": "positive", "b": "negative"}),
                             "t", "p")
    assert cm.count() == 9 and sum(r.n for r in cm.collect()) == 4


def test_class_weights(spark, sf):
    t = fixtures.truth_labels(spark, sf)
    w = {r.label: (r.n_c, r.weight) for r in ev.class_weights(t).collect()}
    n = sum(v[0] for v in w.values())
    for n_c, wt in w.values():
        assert abs(wt - n / (len(w) * n_c)) < 1e-12
