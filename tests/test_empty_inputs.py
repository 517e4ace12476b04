"""Every main job runs on empty inputs and returns an empty (or all-zero) result."""

from lexiscope import fixtures
from lexiscope.operators import curves as cv
from lexiscope.operators import evaluate as ev
from lexiscope.operators import lexicon as lx
from lexiscope.operators import report as rp
from lexiscope.operators import rouge as rg
from lexiscope.operators import sampling as sm
from lexiscope.operators import standardize as sd


def test_empty_inputs(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    assert rp.report_table(docs, lk).count() == 0
    assert rp.report_table_rowwise(docs, lk).count() == 0
    assert lx.tag_lists(docs, lk).count() == 0
    empty_dict = spark.createDataFrame([], "word string, " + ", ".join(f"{c} int" for c in lx.CATEGORIES))
    assert lx.prepare_lookup(empty_dict).rows == 0
    labelled = spark.createDataFrame([], "doc_id long, label string")
    assert sm.stratified_split(labelled, "doc_id", "label").count() == 0
    pairs = spark.createDataFrame([], "t string, p string")
    m = ev.classification_metrics(pairs, "t", "p").first()
    assert m.n is None or m.n == 0
    assert ev.confusion_matrix(spark, pairs, "t", "p").count() == 9
    std = spark.createDataFrame([], "data string, sentiment string")
    assert sd.standardise_job([(std, "data", "sentiment", "sentence")]).count() == 0
    log = spark.createDataFrame([], "run string, s int, loss double")
    assert cv.moving_average(log, "run", ["s"]).count() == 0
    conv = spark.createDataFrame([], "k int, article string, summary string")
    assert rg.rouge_n(conv, ["k"], "summary", "article").count() == 0
    assert rg.summary_checks(conv, "article", "summary").first().n == 0
