"""TF-IDF features, SVM and the RBF approximation (random Fourier features)."""

import numpy as np
from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.operators import evaluate as ev
from lexiscope.operators import models as ml
from lexiscope.operators import standardize as sd
from lexiscope.session import cut_lineage


def _data(spark, sf):
    truth = fixtures.truth_labels(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    d = truth.join(docs, "doc_id").withColumn(
        "label_index", sd.encode_label(F.col("label"), "index").cast("double"))
    w = ev.class_weights(d, "label").select("label", "weight")
    return d.join(F.broadcast(w), "label")


def test_rff_approximates_rbf_kernel(spark, sf):
    """Within five standard errors, 1 / sqrt(D), of the kernel, with D = 1024 components."""
    weights = ml.tfidf_relational(_data(spark, sf))
    some = sorted(r.doc_id for r in weights.select("doc_id").distinct().collect())[:6]
    weights = weights.where(F.col("doc_id").isin(some))
    z = {r.doc_id: r.features.toArray() for r in ml.rff_features(weights, n_components=1024, gamma=0.5).collect()}
    x = {}
    for r in weights.collect():
        x.setdefault(r.doc_id, {})[r.term] = r.weight
    for a in some[:3]:
        for b in some:
            keys = set(x[a]) | set(x[b])
            d2 = sum((x[a].get(k, 0.0) - x[b].get(k, 0.0)) ** 2 for k in keys)
            assert abs(np.exp(-0.5 * d2) - float(np.dot(z[a], z[b]))) < 0.16


def test_frequencies_are_standard_normal(spark):
    terms = spark.createDataFrame([(f"t{i}",) for i in range(200)], "term string")
    w = np.array([r.w for r in ml.frequencies(terms, 128).collect()])
    assert w.shape == (400, 64) and abs(w.mean()) < 0.03 and abs(w.std() - 1) < 0.03 and abs((w ** 4).mean() - 3) < 0.3
    again = {(r.term, r.block): r.w for r in ml.frequencies(terms.repartition(3), 128).collect()}
    assert len(again) == 400 and len({tuple(v) for v in again.values()}) == 400


def test_rff_svm_trains(spark, sf):
    data = _data(spark, sf)
    weights = ml.tfidf_relational(data)
    gamma = ml.rbf_gamma_scale(weights, data.count(), weights.select("term").distinct().count())
    feats = ml.rff_features(weights, n_components=64, gamma=gamma)
    train = cut_lineage(feats.join(data.select("doc_id", "label_index", "weight"), "doc_id"))
    model = ml.fit_svm(train, max_iter=5)
    pred = model.transform(train).select("prediction").collect()
    assert len(pred) == data.count() and {p.prediction for p in pred} <= {0.0, 1.0, 2.0}


def test_rbf_machine_separates_what_a_line_cannot(spark):
    """Exclusive or of two terms: no linear machine gets above three quarters."""
    rows = [(i, f"{'aa' if i & 1 else 'cc'} {'bb' if i & 2 else 'dd'}", float((i & 1) ^ (i >> 1 & 1))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label_index double").withColumn("weight", F.lit(1.0))
    feats = cut_lineage(ml.rff_features(ml.tfidf_relational(df), n_components=64, gamma=1.0).join(df, "doc_id"))
    got = ml.fit_svm(feats, max_iter=20).transform(feats).select("label_index", "prediction").collect()
    assert np.mean([r.label_index == r.prediction for r in got]) == 1.0


def test_svm_learns_a_text_dependent_label(spark):
    """Label = the lexicon's vote (a function of the text): the TF-IDF + SVM
    pipeline must beat the majority class on held-out documents."""
    from lexiscope.operators import lexicon as lx
    from lexiscope.operators import sampling as sm
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sig = lx.lexicon_signals(docs, lx.prepare_lookup(fixtures.fixture_dictionary(spark)))
    data = sm.train_test(docs.join(sig.select("doc_id", F.col("lexicon_label").alias("label")), "doc_id"),
                         "doc_id").withColumn(
        "label_index", sd.encode_label(F.col("label"), "index").cast("double")).cache()
    train = data.where(F.col("split") == "train")
    w = ev.class_weights(train, "label").select("label", "weight")
    train = train.join(F.broadcast(w), "label")
    feats = ml.fit_tfidf(train)
    model = ml.fit_svm(feats.transform(train))
    test = data.where(F.col("split") == "test")
    pred = model.transform(feats.transform(test)).select("label_index", "prediction").collect()
    acc = sum(p.label_index == p.prediction for p in pred) / len(pred)
    majority = max(sum(p.label_index == k for p in pred) for k in (0.0, 1.0, 2.0)) / len(pred)
    assert acc > majority + 0.05, (acc, majority)
