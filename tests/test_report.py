"""Reliability report: reasons, tiers, nested schema, softmax decode, stubs."""

import json

from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.operators import lexicon as lx
from lexiscope.operators import report as rp


def test_reasons_and_tiers(spark):
    rows = [("positive", 0.55, "negative", False, 0.1),
            ("neutral", 0.5499, "neutral", True, 0.2),
            ("negative", 0.9, "negative", False, 0.15)]
    df = spark.createDataFrame(rows, "m string, c double, l string, f boolean, s double")
    out = df.select(*rp.reliability_columns(F.col("m"), F.col("c"), F.col("l"), F.col("f"),
                                            F.col("s"))).collect()
    assert [(r.reasons, r.reliability) for r in out] == [
        (["model_lexicon_disagreement"], "medium"),
        (["low_finbert_confidence", "high_lexicon_bias"], "low"),
        ([], "high")]


def test_softmax_decode(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0],), ([0.0, 0.0, 0.0],)], "z array<double>")
    probs, label, conf = rp.softmax_decode(F.col("z"))
    out = df.select(label.alias("l"), conf.alias("c"), probs.alias("p")).collect()
    assert out[0].l == "negative" and abs(out[0].c - 0.6652) < 1e-9
    assert abs(sum(out[0].p) - 1) < 1e-12 and out[1].l == "positive" and out[1].c == 0.3333


def test_nested_report_and_json(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    flat = rp.report_table(docs, lk)
    nested = rp.nested_report(flat)
    fields = nested.schema["report"].dataType.fieldNames()
    assert fields == ["summary", "finbert", "lexicon", "bias", "agreement", "reliability", "reasons"]
    js = rp.report_json(nested).first().json
    obj = json.loads(js)
    assert set(obj["bias"]) == {"uncertainty", "litigious", "constraining", "score", "flag"}
    assert all(v > 0 for v in obj["lexicon"]["counts"].values())
    checks = rp.report_checks(flat).first().asDict()
    assert checks["n_reports"] == docs.count()
    assert all(v == 0 for k, v in checks.items() if k.startswith("bad_"))


def test_caller_supplied_classifier(spark):
    from lexiscope.operators import models as ml
    docs = spark.createDataFrame([(1, "aaa bbb"), (2, "zzz")], "doc_id long, text string")
    udf = ml.batch_classifier(ml.hashed_logits_model)
    classify = rp.model_classifier(udf)
    out = classify(docs, "doc_id", "text").collect()
    assert all(r.cls_label in rp.CLASS_LABELS and 0 < r.cls_conf <= 1 for r in out)
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    flat = rp.report_table(docs, lk, classifier=classify).collect()
    assert len(flat) == 2 and all(r.finbert_label in rp.CLASS_LABELS for r in flat)


def test_letter_stub_reads_the_whole_text(spark):
    import math
    # 3 g, 1 b, 0 k; nothing; the deciding letters at the end of a long text.
    texts = ["Gig bug", None, "x" * 100_000 + "KkbK"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.cls_label, r.cls_conf) for r in rp.letter_stub_classifier(df, "doc_id", "text").collect()}
    sure = round(math.exp(3.0) / (math.exp(3.0) + math.exp(1.0) + 1.0), 4)
    assert got == {0: ("positive", sure), 1: ("positive", 0.3333), 2: ("neutral", sure)}


def test_caller_supplied_summariser(spark):
    import numpy as np
    from lexiscope.operators import models as ml

    def make():
        def predict(texts: np.ndarray) -> np.ndarray:
            return np.array([" ".join((t or "").split()[:3]) for t in texts], dtype=object)
        return predict
    summarise = ml.batch_summariser(make)
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x")], "doc_id long, text string")
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    flat = rp.report_table(docs, lk, summariser=lambda i, t: summarise(t))
    assert {r.doc_id: r.summary for r in flat.collect()} == {1: "a b c", 2: "x"}


def test_model_classifier_query_matches_numpy(spark, sf):
    import numpy as np
    from lexiscope.plans.queries import QUERIES
    from lexiscope.operators import models as ml
    got = {r.doc_id: (r.label, r.confidence) for r in QUERIES["model_classifier_signals"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    predict = ml.hashed_logits_model()
    for d in docs:
        z = predict(np.array([d.text], dtype=object))[0]
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        i = int(np.argmax(p))
        assert got[d.doc_id][0] == rp.CLASS_LABELS[i]
        assert abs(got[d.doc_id][1] - round(float(p[i]), 4)) < 1e-9


def test_reference_json_format_pieces(spark):
    import random
    rnd = random.Random(3)
    chars = [chr(c) for c in range(0, 0x30)] + list('"\\/é€ß \U0001F600abc ')
    strings = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(strings)], "i int, t string")
    got = {r.i: r.j for r in df.select("i", rp.json_string(F.col("t")).alias("j")).collect()}
    for i, t in enumerate(strings):
        assert got[i] == json.dumps(t, ensure_ascii=False), repr(t)
    nums = [round(rnd.random(), 4) for _ in range(300)] + [0.0, 1.0, 0.0005, 0.0001, 0.15]
    dn = spark.createDataFrame([(i, x) for i, x in enumerate(nums)], "i int, x double")
    got = {r.i: r.j for r in dn.select("i", rp.json_number_4(F.col("x")).alias("j")).collect()}
    for i, x in enumerate(nums):
        assert got[i] == json.dumps(x), x


def test_reference_json_roundtrips_through_python(spark, sf):
    from lexiscope.plans.queries import QUERIES
    for r in QUERIES["report_json_text"](spark, sf).collect():
        assert json.dumps(json.loads(r.json), ensure_ascii=False) == r.json


def test_demo_expectations_end_to_end(spark):
    """Positive and negative articles are reliable (high); a speculative one is
    flagged for lexical bias - the behaviour the reference's demo describes."""
    cats = list(lx.CATEGORIES)
    words = {"GROWTH": "positive", "RECORD": "positive", "GAINS": "positive", "BEAT": "positive",
             "LOSS": "negative", "DEFECTS": "negative", "PLUNGED": "negative", "HALT": "negative",
             "MAY": "uncertainty", "UNCERTAIN": "uncertainty", "POSSIBLE": "uncertainty",
             "LITIGATION": "litigious", "INVESTIGATIONS": "litigious",
             "RESTRICTIONS": "constraining", "CONSTRAINED": "constraining", "COULD": "weak_modal"}
    dic = spark.createDataFrame([tuple([w] + [1 if c == t else 0 for c in cats]) for w, t in words.items()],
                                "word string, " + ", ".join(f"{c} int" for c in cats))
    lk = lx.prepare_lookup(dic)
    articles = [
        (1, "Quarterly revenue set a record and gains beat forecasts, with strong growth in services."),
        (2, "The maker posted a loss after defects forced a halt to deliveries; shares plunged."),
        (3, "Regulators may widen investigations, and possible litigation could bring restrictions; "
            "the outcome is uncertain and deliveries may be constrained."),
    ]
    docs = spark.createDataFrame(articles, "doc_id long, text string")
    tone = {1: "positive", 2: "negative", 3: "neutral"}

    def classifier(df, id_col, text_col):
        label = F.element_at(F.create_map(*[F.lit(x) for kv in tone.items() for x in kv]), F.col(id_col))
        return df.withColumn("cls_label", label).withColumn("cls_conf", F.lit(0.93))

    out = {r.doc_id: r for r in rp.report_table(docs, lk, classifier=classifier).collect()}
    assert out[1].lexicon_label == "positive" and out[1].reliability == "high"
    assert out[2].lexicon_label == "negative" and out[2].reliability == "high"
    assert out[3].bias_score > 0.15 and out[3].bias_flag and "high_lexicon_bias" in out[3].reasons


def test_nested_counts_in_first_seen_order(spark):
    import json as _json
    docs = spark.createDataFrame([(1, "ou er tion er ou ou")], "doc_id long, text string")
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    flat = rp.report_table(docs, lk, keep_positions=True)
    counts = _json.loads(rp.report_json(rp.nested_report(flat)).first().json)["lexicon"]["counts"]
    assert list(counts.items()) == [("uncertainty", 3), ("negative", 2), ("positive", 1)]
    text = _json.loads(rp.report_json_python(flat).first().json)["lexicon"]["counts"]
    assert list(text.items()) == list(counts.items())


def test_repeated_ids_fail_where_asked(spark):
    import pytest
    from lexiscope import fixtures
    from lexiscope.operators import lexicon as lx
    from lexiscope.operators import report as rp
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    docs = spark.createDataFrame([(1, "tion er"), (2, ""), (3, None), (4, ". . la")], "doc_id long, text string")
    assert rp.report_table(docs, lk, unique_ids=True).count() == 4
    with pytest.raises(Exception, match="doc_id is not unique: 2"):
        rp.report_table(docs.union(docs.where("doc_id = 2")), lk, unique_ids=True).collect()


def test_prompt_reaches_the_summariser_only(spark):
    from lexiscope import fixtures
    from lexiscope.functions import text as tx
    from lexiscope.operators import lexicon as lx
    from lexiscope.operators import report as rp
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    docs = spark.createDataFrame([(1, "tion er")], "doc_id long, text string")
    seen = lambda doc_id, text: text
    plain, asked = (rp.report_table(docs, lk, summariser=seen, prompt=p).first() for p in (False, True))
    assert plain.summary == "tion er" and asked.summary == (tx.NEUTRAL_PROMPT_PREFIX + "tion er").strip()
    assert plain.n_tags == asked.n_tags
