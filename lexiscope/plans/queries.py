"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.functions import text as tx
from lexiscope.operators import curves as cv
from lexiscope.operators import evaluate as ev
from lexiscope.operators import lexicon as lx
from lexiscope.operators import models as ml
from lexiscope.operators import report as rp
from lexiscope.operators import rouge as rg
from lexiscope.operators import sampling as sm
from lexiscope.operators import standardize as sd
from lexiscope.plans.ordering import indexed_scan
from lexiscope.session import cut_lineage, read_table, scratch_path
from lexiscope.sources import readers as rd
from lexiscope.sources import sinks as sk


_LOOKUPS: dict = {}


def _lookup(spark: SparkSession, mode: str = "before_lookup") -> lx.Lookup:
    """The fixture dictionary's lookup, checked and sized once per application."""
    key = (spark.sparkContext.applicationId, mode)
    if key not in _LOOKUPS:
        _LOOKUPS[key] = lx.prepare_lookup(fixtures.fixture_dictionary(spark), stopword_mode=mode)
    return _LOOKUPS[key]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


# ---- lexicon -------------------------------------------------------------


def q_lexicon_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3-L8 (chain stopword mode): one row per document."""
    return lx.lexicon_signals(_docs(spark, sf_dir), _lookup(spark))


def q_lexicon_signals_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3-L8 as for a dictionary beyond the broadcast bound: a shuffled join without hot keys."""
    return lx.lexicon_signals(_docs(spark, sf_dir), dataclasses.replace(_lookup(spark), broadcast=False))


def q_lexicon_signals_rowwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3-L8 in the row-wise shape (array functions, no shuffle)."""
    return lx.lexicon_signals_rowwise(_docs(spark, sf_dir), _lookup(spark))


def q_lexicon_signals_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L8 against the large dictionary derived from the corpus vocabulary."""
    lk = lx.prepare_lookup(fixtures.derived_dictionary(spark, sf_dir))
    return lx.lexicon_signals(_docs(spark, sf_dir), lk)


def q_report_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 flagship: the flat reliability report per document."""
    flat = rp.report_table(_docs(spark, sf_dir), _lookup(spark))
    return flat.withColumn("reasons", F.array_join("reasons", ","))


def q_report_flat_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 over a corpus stored in buckets of ``doc_id``: neither the aggregate nor the fan-in moves a row, and the same
    pass checks that ids are unique."""
    name = "corpus_" + uuid.uuid4().hex[:12]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sk.write_bucketed_table(_docs(spark, sf_dir), name, "doc_id", buckets=buckets)
    flat = rp.report_table(spark.table(name), _lookup(spark), unique_ids=True)
    return flat.withColumn("reasons", F.array_join("reasons", ","))


def q_report_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 + K2: nested report serialised as one JSON object per document
    (tag counts in first-seen order, as in the reference's dict)."""
    flat = rp.report_table(_docs(spark, sf_dir), _lookup(spark), keep_positions=True)
    return rp.report_json(rp.nested_report(flat))


def q_report_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 in the reference's text form (``json.dumps(report, ensure_ascii=False)``)."""
    flat = rp.report_table(_docs(spark, sf_dir), _lookup(spark), keep_positions=True)
    return rp.report_json_python(flat)


def q_report_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bound / closed-set violations over all reports."""
    return rp.report_checks(rp.report_table(_docs(spark, sf_dir), _lookup(spark)))


def q_token_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept token with its tag (long form)."""
    return lx.token_tags(_docs(spark, sf_dir), _lookup(spark))


def q_tag_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: ordered tag list per document (joined for comparison)."""
    tl = lx.tag_lists(_docs(spark, sf_dir), _lookup(spark))
    return tl.select("doc_id", F.array_join("sentiment_list", ",").alias("sentiment_list"))


def q_rule_based_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch tagger mode: dictionary stopwords only, litigious dropped (null label)."""
    sig = lx.lexicon_signals(_docs(spark, sf_dir), _lookup(spark, "in_dictionary"),
                             litigious="drop")
    return sig.select("doc_id", "n_cns", "n_tags", "lexicon_tag", "lexicon_label")


def q_dictionary_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: profile of the dictionary derived from the corpus (words per category,
    doc_count total, stopwords among its words)."""
    return lx.dictionary_profile(fixtures.derived_dictionary(spark, sf_dir))


def q_dictionary_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 rendered as the dictionary-load log lines (corpus-derived dictionary)."""
    return lx.dictionary_log_lines(lx.dictionary_profile(fixtures.derived_dictionary(spark, sf_dir)))


def q_bias_flag_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged / total / percent over all documents."""
    return lx.flag_rate(lx.lexicon_signals(_docs(spark, sf_dir), _lookup(spark)))


# ---- standardise / clean -----------------------------------------------------


def _std_sources(spark: SparkSession, sf_dir: str):
    sentences, headlines = fixtures.labelled_sources(spark, sf_dir)
    return [(sentences, "data", "sentiment", "sentence"),
            (headlines, "Title", "Global Sentiment", "headline")]


def q_standardised_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P4 per source, before cleaning (what the per-source files hold)."""
    parts = [sd.standardise(df, d, lbl, dt) for df, d, lbl, dt in _std_sources(spark, sf_dir)]
    return parts[0].unionByName(parts[1])


def q_stitched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardise -> clean (T5) -> drop blanks -> stitch + de-duplicate."""
    return sd.standardise_job(_std_sources(spark, sf_dir))


def q_clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 on raw HTML pages."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.clean_text(F.col("html")).alias("clean"))


def q_strip_markup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 alone on raw HTML pages."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.strip_markup(F.col("html")).alias("stripped"))


def q_ascii_fold_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on every document."""
    return _docs(spark, sf_dir).select("doc_id", tx.ascii_fold(F.col("text")).alias("folded"))


def q_pairs_light_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article/summary pairs (P6), light clean (T6) on both sides."""
    pairs = fixtures.conversation_pairs(spark, sf_dir)
    return pairs.select("conv_id", "turn",
                        tx.light_clean(F.col("article")).alias("article"),
                        tx.light_clean(F.col("summary")).alias("summary"))


def q_label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 (string and numeric forms) + P7 encodings."""
    sentences, headlines = fixtures.labelled_sources(spark, sf_dir)
    s = sentences.select("doc_id", sd.normalise_label(sentences, "sentiment").alias("label"))
    h = headlines.select("doc_id", sd.normalise_label(headlines, "Global Sentiment").alias("label"))
    both = s.unionByName(h)
    return both.select("doc_id", "label",
                       sd.encode_label(F.col("label"), "index").alias("label_index"),
                       sd.encode_label(F.col("label"), "sign").alias("label_sign"))


def q_input_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted articles (stripped) vs rejected empty ones."""
    sentences, headlines = fixtures.labelled_sources(spark, sf_dir)
    arts = sentences.select("doc_id", F.col("data").alias("text")).unionByName(
        headlines.select("doc_id", F.col("Title").alias("text")))
    ok, bad = sd.guard_nonempty(arts)
    return ok.select("doc_id", F.lit(True).alias("accepted"), F.length("text").cast("bigint").alias("n_chars")) \
        .unionByName(bad.select("doc_id", F.lit(False).alias("accepted"),
                                F.lit(None).cast("bigint").alias("n_chars")))


def q_prompted_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summariser input with the neutral instruction (hash + length of the whole prompt)."""
    p = tx.with_prompt(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(p).alias("prompt_md5"),
                                       F.length(p).cast("bigint").alias("prompt_chars"))


# ---- sampling / splits -------------------------------------------------------


def q_seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: documents in seeded order (sort key kept)."""
    return sm.seeded_shuffle(_docs(spark, sf_dir).select("doc_id"), "doc_id")


def q_seeded_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the first 1,500 documents of the seeded order (top-k)."""
    return sm.seeded_subset(_docs(spark, sf_dir).select("doc_id"), "doc_id", 1500)


def q_fraction_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: half of the labelled documents by hash threshold."""
    return sm.fraction_sample(fixtures.truth_labels(spark, sf_dir), "doc_id", 0.5)


def q_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unstratified 80/20 over the labelled documents."""
    return sm.train_test(fixtures.truth_labels(spark, sf_dir), "doc_id")


def q_train_val_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80/10/10 over all documents."""
    return sm.train_val_test(_docs(spark, sf_dir).select("doc_id"), "doc_id")


def _strat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.stratified_split(fixtures.truth_labels(spark, sf_dir), "doc_id", "label")


def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact per-class 64/16/20 split of the labelled documents."""
    return _strat(spark, sf_dir)


# ---- evaluation ---------------------------------------------------------------


def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: rows per split of the stratified split."""
    return ev.split_counts(_strat(spark, sf_dir))


def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: balanced class weights over the training split."""
    return ev.class_weights(_strat(spark, sf_dir).where(F.col("split") == "train"))


def _rule_vs_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions beside labels; only labelled documents are tagged."""
    truth = fixtures.truth_labels(spark, sf_dir)
    labelled = _docs(spark, sf_dir).join(truth.select("doc_id"), "doc_id", "left_semi")
    pred = lx.lexicon_signals(labelled, _lookup(spark, "in_dictionary"),
                              litigious="drop").select("doc_id", F.col("lexicon_label").alias("pred"))
    return truth.join(pred, "doc_id")


def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: rule-based prediction vs label, all nine cells."""
    return ev.confusion_matrix(spark, _rule_vs_truth(spark, sf_dir), "label", "pred")


def q_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: accuracy and weighted P/R/F1 of the rule-based prediction."""
    return ev.classification_metrics(_rule_vs_truth(spark, sf_dir), "label", "pred")


def q_per_row_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: test-split rows with classifier label, confidence, bias and true label."""
    test = _strat(spark, sf_dir).where(F.col("split") == "test")
    docs = _docs(spark, sf_dir).join(test.select("doc_id"), "doc_id", "left_semi")
    flat = rp.report_table(docs, _lookup(spark))
    sig = flat.select("doc_id", F.col("finbert_label").alias("sentiment"),
                      F.col("finbert_confidence").alias("confidence"),
                      "uncertainty", "litigious", "constraining", "bias_score", "bias_flag")
    return ev.per_row_results(sig, test)


# ---- summaries and ROUGE ---------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.conversation_pairs(spark, sf_dir)


def q_rouge_n_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROUGE-1/2 P/R/F per pair (prediction = assistant turn, reference = user turn)."""
    return rg.rouge_n(_pairs(spark, sf_dir), ["conv_id", "turn"], "summary", "article")


def q_rouge_n_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus ROUGE-1/2 (mean F over pairs, 3 places)."""
    per = rg.rouge_n(_pairs(spark, sf_dir), ["conv_id", "turn"], "summary", "article")
    return rg.mean_scores(per, ["rouge1_f", "rouge2_f"])


def q_rouge_l_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROUGE-L / ROUGE-Lsum F per pair (LCS in an Arrow UDF)."""
    return rg.rouge_l(_pairs(spark, sf_dir), ["conv_id", "turn"], "summary", "article")


def q_rouge_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + A8 on Porter stems: ROUGE-1/2/L/Lsum per pair."""
    key = ["conv_id", "turn"]
    pairs = cut_lineage(rg.stemmed(_pairs(spark, sf_dir), key, ["article", "summary"]))
    per_l = rg.rouge_l(pairs, key, "summary", "article")
    return rg.rouge_n(pairs, key, "summary", "article").select(*key, "rouge1_f", "rouge2_f").join(per_l, key)


def q_rouge_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low / mid / high of the corpus scores on stems over bootstrap replicates."""
    return rg.bootstrap(q_rouge_stemmed(spark, sf_dir), ["conv_id", "turn"],
                        ["rouge1_f", "rouge2_f", "rougeL_f", "rougeLsum_f"])


def q_summary_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emptiness, length, compression, distinctness and ROUGE-floor checks over all pairs."""
    pairs = _pairs(spark, sf_dir)
    scores = rg.rouge_n(pairs, ["conv_id", "turn"], "summary", "article")
    return rg.summary_checks(pairs, "article", "summary", scores, ["conv_id", "turn"])


def q_stub_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML6 (stub model): one summary per document over the whole text."""
    docs = _docs(spark, sf_dir)
    return docs.select("doc_id", rp.lead_stub_summariser(F.col("doc_id"), F.col("text")).alias("summary"))


def q_summary_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: summarise every document twice and count differing outputs."""
    a = q_stub_summaries(spark, sf_dir)
    b = q_stub_summaries(spark, sf_dir)
    return rg.stability(a, b, ["doc_id"], "summary")


# ---- training curves ---------------------------------------------------------------

LOG_ORDER = ["ts", "event_id"]


def _log_with_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixtures.training_log(spark, sf_dir)
    return indexed_scan(log, "run", LOG_ORDER).withColumn("step", F.col("idx") + 1)


def q_log_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss / eval_loss series by key presence, with the step of each record."""
    return cv.series(_log_with_steps(spark, sf_dir))


def q_loss_moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing moving average of the training loss, window max(1, n // 100)."""
    log = fixtures.training_log(spark, sf_dir)
    is_train = F.col("loss").isNotNull() & F.col("eval_loss").isNull() & F.col("epoch").isNotNull()
    ma = cv.moving_average(log.select("run", *LOG_ORDER, "loss", is_train.alias("_train")),
                           "run", LOG_ORDER, "loss", member=F.col("_train"))
    return ma.select("run", "step", "loss", "window", "smoothed")


def q_newest_training_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + K1: every run's log written as up to three checkpoints (thirds of the log's time span, one after another),
    the newest of each run found by file times and read back."""
    root = scratch_path(spark, "training-logs")
    log = fixtures.training_log(spark, sf_dir).withColumn("us", F.expr(
        f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{fixtures.LOG_EPOCH_ORIGIN}', CAST(ts AS TIMESTAMP_NTZ))"))
    span = log.agg(F.min("us").alias("a"), F.max("us").alias("b")).first()
    if span["a"] is None:
        return spark.createDataFrame([], "run bigint, checkpoint bigint, step bigint, loss double, eval_loss double")
    third = F.expr(f"(us - {span['a']}L) * 3 div {span['b'] - span['a'] + 1}L")
    for k in range(3):
        part = log.where(third == k).select("run", F.col("event_id").alias("step"), "epoch", "loss", "eval_loss")
        sk.write_training_log(part, root, "run", k + 1)
    back = rd.read_training_logs(spark, root, lines=True)
    return back.select(F.col("run").cast("bigint").alias("run"), "checkpoint", "step", "loss", "eval_loss")


def q_epoch_mean_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean training loss per ceil(epoch)."""
    return cv.epoch_mean_loss(cv.training_rows(fixtures.training_log(spark, sf_dir)))


def q_epoch_last_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last eval loss per half-even-rounded epoch."""
    return cv.epoch_last_eval(fixtures.training_log(spark, sf_dir), "run", LOG_ORDER)


def q_best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run with the highest score (ties by listing order, unscored last)."""
    scores = fixtures.run_scores(spark, sf_dir)
    return cv.pick_best(scores, "run", "score", "run", fallback="fallback-model")


# ---- statistical model -------------------------------------------------------------


def _labelled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with an 80/20 split (O4) and the label index."""
    truth = fixtures.truth_labels(spark, sf_dir)
    docs = _docs(spark, sf_dir)
    return sm.train_test(truth.join(docs, "doc_id"), "doc_id").withColumn(
        "label_index", sd.encode_label(F.col("label"), "index").cast("double"))


def q_tfidf_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1: TF-IDF weights (fit on train, applied to all labelled documents)."""
    data = _labelled_split(spark, sf_dir)
    return ml.tfidf_relational(data, F.col("split") == "train")


RFF_COMPONENTS = 64


def _rbf(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, float]:
    """Labelled documents with their split, their TF-IDF rows, and ``gamma='scale'`` of the training rows."""
    data = cut_lineage(_labelled_split(spark, sf_dir).select("doc_id", "text", "label", "label_index", "split"))
    train = F.col("split") == "train"
    weights = cut_lineage(ml.tfidf_relational(data, train))
    used = weights.agg(F.count_distinct("term").alias("n")).first()["n"]
    ids = data.where(train).select("doc_id")
    gamma = ml.rbf_gamma_scale(weights.join(ids, "doc_id", "left_semi"), ids.count(), max(used, 1))
    return data, weights, gamma


def q_rff_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2: random Fourier features of the RBF kernel for every labelled document."""
    _, weights, gamma = _rbf(spark, sf_dir)
    parts = ml.rff_components(weights, RFF_COMPONENTS, gamma)
    return parts.select("doc_id", "component", F.round("value", 6).alias("value"))


def q_rbf_svm_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2 + ML3 with the RBF kernel: predicted label and per-class decision scores for the test split."""
    data, weights, gamma = _rbf(spark, sf_dir)
    rows = cut_lineage(data.drop("text").join(ml.rff_features(weights, 256, gamma), "doc_id"))
    train = rows.where(F.col("split") == "train")
    classes = ev.class_weights(train, "label").select("label", "weight")
    model = ml.fit_svm(train.join(F.broadcast(classes), "label"))  # <= 3 rows
    pred = model.transform(rows.where(F.col("split") == "test"))
    scores = ml.decision_scores(pred)
    return pred.select(
        "doc_id", F.col("label").alias("true_label"),
        sd.decode_label(F.col("prediction").cast("int"), "index").alias("pred_label"),
        *[scores[c].alias(f"score_{c}") for c in ml.CLASS_NAMES])


_FITTED: dict = {}


def _svm(spark: SparkSession, sf_dir: str):
    """Fit once per (application, data folder); the three ML queries share the model."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = _fit_svm(spark, sf_dir)
    return _FITTED[key]


def _fit_svm(spark: SparkSession, sf_dir: str):
    data = _labelled_split(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    weights = ev.class_weights(train, "label").select("label", "weight")
    train = train.join(F.broadcast(weights), "label")  # <= 3 rows
    feats = ml.fit_tfidf(train)
    model = ml.fit_svm(feats.transform(train))
    return data, feats, model


def q_model_classifier_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML4 + ML5: a caller-supplied batch model (here a deterministic stand-in)
    run through an Arrow batch UDF, its logits decoded by softmax."""
    classify = rp.model_classifier(ml.batch_classifier(ml.hashed_logits_model))
    out = classify(_docs(spark, sf_dir), "doc_id", "text")
    return out.select("doc_id", F.col("cls_label").alias("label"), F.col("cls_conf").alias("confidence"))


def q_softmax_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML5: softmax decode of per-document logits (here the positive / negative /
    uncertainty tag counts), label by arg-max, confidence to 4 places."""
    sig = lx.lexicon_signals(_docs(spark, sf_dir), _lookup(spark))
    staged = sig.select("doc_id", F.array(*[F.col(c).cast("double") for c in
                                            ("n_positive", "n_negative", "n_uncertainty")]).alias("z"))
    _, label, conf = rp.softmax_decode(F.col("z"))
    return staged.select("doc_id", label.alias("label"), conf.alias("confidence"))


def q_svm_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2 + ML3: predicted label and per-class decision scores for the test split."""
    data, feats, model = _svm(spark, sf_dir)
    pred = model.transform(feats.transform(data.where(F.col("split") == "test")))
    scores = ml.decision_scores(pred)
    return pred.select(
        "doc_id", F.col("label").alias("true_label"),
        sd.decode_label(F.col("prediction").cast("int"), "index").alias("pred_label"),
        *[scores[c].alias(f"score_{c}") for c in ml.CLASS_NAMES])


def q_svm_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 on the SVM's test predictions."""
    return ev.classification_metrics(q_svm_predictions(spark, sf_dir), "true_label", "pred_label")


def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML7: persist features + SVM to the shared folder, reload, compare predictions."""
    from pyspark.ml.classification import OneVsRestModel
    from pyspark.ml import PipelineModel
    from lexiscope.session import scratch_path
    data, feats, model = _svm(spark, sf_dir)
    fpath, mpath = scratch_path(spark, "tfidf"), scratch_path(spark, "svm")
    ml.save_model(feats, fpath)
    ml.save_model(model, mpath)
    feats2, model2 = PipelineModel.load(fpath), OneVsRestModel.load(mpath)
    test = data.where(F.col("split") == "test")
    a = model.transform(feats.transform(test)).select("doc_id", F.col("prediction").alias("a"))
    b = model2.transform(feats2.transform(test)).select("doc_id", F.col("prediction").alias("b"))
    return a.join(b, "doc_id").agg(F.count(F.lit(1)).alias("n"),
                                   F.count_if(F.col("a") != F.col("b")).alias("n_changed"))


# ---- sources and sinks: round trips through the shared folder -------------------


def q_csv_sources_stitched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + S3 + K1 -> U2: write both labelled sources as CSV, discover, re-read, stitch."""
    root = scratch_path(spark, "raw-sentiment")
    sentences, headlines = fixtures.labelled_sources(spark, sf_dir)
    sk.write_table(sentences.select("sentiment", "data"), f"{root}/FPB_sentences/raw.csv",
                   fmt="csv", header=False)
    sk.write_table(headlines.select("Title", "Global Sentiment"), f"{root}/FMB_headlines/raw.csv",
                   fmt="csv")
    found = rd.discover_labelled_sources(spark, root)
    parts = []
    for path in found.get("sentence", []):
        parts.append((rd.read_headerless_labelled(spark, path), "data", "sentiment", "sentence"))
    for path in found.get("headline", []):
        parts.append((rd.read_headed_labelled(spark, path), "Title", "Global Sentiment", "headline"))
    return sd.standardise_job(parts)


def q_csv_pairs_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + K1 -> U3: pairs written as train/validation/test CSV, re-read in one scan."""
    folder = scratch_path(spark, "pairs")
    pairs = sm.train_val_test(fixtures.conversation_pairs(spark, sf_dir), "conv_id")
    for split in ("train", "validation", "test"):
        sk.write_table(pairs.where(F.col("split") == split).select("conv_id", "turn", "article", "summary"),
                       f"{folder}/{split}.csv", fmt="csv")
    back = rd.read_pairs_by_split(spark, folder)
    out = sd.prepare_pairs(back, mode="strip")
    return out.select("article", "summary", "split")


def q_tag_list_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S7: tag lists written as legacy list-literal text, parsed back."""
    path = scratch_path(spark, "tag-lists")
    tl = lx.tag_lists(_docs(spark, sf_dir), _lookup(spark))
    truth = fixtures.truth_labels(spark, sf_dir)
    table = tl.join(truth, "doc_id").join(_docs(spark, sf_dir), "doc_id").select(
        "doc_id", F.col("text").alias("data"),
        F.concat(F.lit(" "), F.upper("label"), F.lit(" ")).alias("sentiment"),
        sk.tag_list_literal(F.col("sentiment_list")).alias("sentiment_list"))
    sk.write_table(table, path, fmt="csv")
    back = rd.read_tag_lists(spark, path, fmt="csv")
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "sentiment",
                       F.array_join("sentiment_list", ",").alias("sentiment_list"))


def q_reports_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: nested reports written as JSON lines, read back and flattened."""
    path = scratch_path(spark, "reports")
    flat = rp.report_table(_docs(spark, sf_dir), _lookup(spark))
    sk.write_reports_json(rp.nested_report(flat), path)
    back = spark.read.schema(rp.nested_report(flat).schema).json(path)
    return back.select(
        "doc_id", F.col("report.summary").alias("summary"),
        F.col("report.finbert.label").alias("finbert_label"),
        F.col("report.finbert.confidence").alias("finbert_confidence"),
        F.col("report.lexicon.label").alias("lexicon_label"),
        F.col("report.bias.score").alias("bias_score"), F.col("report.bias.flag").alias("bias_flag"),
        F.col("report.agreement").alias("agreement"), F.col("report.reliability").alias("reliability"),
        F.array_join("report.reasons", ",").alias("reasons"))


def q_run_metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + S9 + W5: per-run metrics written as JSON, read back, best run picked."""
    path = scratch_path(spark, "run-metrics")
    scores = fixtures.run_scores(spark, sf_dir)
    metrics = scores.select(
        F.col("run").cast("string").alias("run"),
        F.concat(F.lit("checkpoint-"), F.col("run")).alias("best_checkpoint"),
        F.col("score").alias("best_metric_eval_rougeL_subset"),
        F.struct(F.col("score").alias("eval_rougeL")).alias("validation"),
        F.struct(F.col("score").alias("final_test_rougeL")).alias("test"))
    sk.write_run_metrics(metrics, path)
    back = rd.read_run_metrics(spark, path, multi_line=False)
    return cv.pick_best(back.withColumn("pos", F.col("run").cast("bigint")), "run", "score", "pos",
                        fallback="fallback-model")


def q_csv_pair_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + P6 + T6: pairs written as one CSV with ``ctext``/``text`` columns, re-read."""
    path = scratch_path(spark, "pairs-file")
    pairs = fixtures.conversation_pairs(spark, sf_dir)
    sk.write_table(pairs.select(F.col("article").alias("ctext"), F.col("summary").alias("text"),
                                "conv_id"), path, fmt="csv")
    back = rd.read_pairs_file(spark, path, encoding="UTF-8")
    return sd.prepare_pairs(back, mode="light")


def q_dictionary_csv_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S6 + L2: the corpus-derived dictionary written in the 17-column CSV
    layout, read back by position (profile) and by name (7-category projection)."""
    path = scratch_path(spark, "dictionary")
    d = fixtures.derived_dictionary(spark, sf_dir)
    full = d.select(
        "word", F.lit(0).cast("bigint").alias("seq_num"), F.lit(0).cast("bigint").alias("word_count"),
        *[F.lit(0.0).alias(c) for c in ("word_proportion", "average_proportion", "std_dev")],
        "doc_count", "negative", "positive", "uncertainty", "litigious", "strong_modal",
        "weak_modal", "constraining", "complexity", F.lit(1).alias("syllables"),
        F.lit("derived").alias("source"))
    sk.write_table(full.select(*[F.col(c).alias(h) for c, h in zip(full.columns, fixtures.DICTIONARY_HEADER)]),
                   path, fmt="csv")
    profile = lx.dictionary_profile(rd.read_full_dictionary(spark, path))
    lookup = lx.prepare_lookup(rd.read_dictionary(spark, path))
    return profile.withColumn("lookup_rows", F.lit(lookup.rows).cast("bigint"))


def q_text_corpus_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S8 -> R5: one ``.txt`` file per document in a few folders, read as whole files and reported by path; the
    narrow reports get their ids from the manifest."""
    path = scratch_path(spark, "corpus")
    manifest = sk.write_text_corpus(_docs(spark, sf_dir), path)
    # The article is the stripped file content.
    back = rd.read_text_corpus(spark, f"{path}/files", rd.corpus_tasks(manifest)).withColumn("text", tx.py_strip(F.col("text")))
    flat = rp.report_table(back, _lookup(spark)).select(
        *rd.corpus_places(), "lexicon_label", "n_tags", "bias_score", "reliability")
    return flat.join(manifest, ["part", "number"]).select(
        "doc_id", "lexicon_label", "n_tags", "bias_score", "reliability")


def q_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as a stateless stream (available-now trigger), read back."""
    from lexiscope.streaming.report_stream import read_stream_output, start_report_stream, table_source
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = start_report_stream(spark, table_source(f"{sf_dir.rstrip('/')}/documents.parquet"), sink, ckpt, _lookup(spark))
    q.awaitTermination()
    return read_stream_output(spark, sink)


def q_report_stream_rowwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 as a plain append-mode file stream (row-wise report, no state), read back."""
    from lexiscope.streaming.report_stream import start_rowwise_report_stream, table_source
    sink, ckpt = scratch_path(spark, "stream-rw-out"), scratch_path(spark, "stream-rw-ckpt")
    q = start_rowwise_report_stream(spark, table_source(f"{sf_dir.rstrip('/')}/documents.parquet"), sink, ckpt, _lookup(spark))
    q.awaitTermination()
    return spark.read.parquet(sink)


def q_report_stream_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 as a plain append-mode stream with the large dictionary derived from the corpus."""
    from lexiscope.streaming.report_stream import read_stream_output, start_rowwise_report_stream, table_source
    sink, ckpt = scratch_path(spark, "stream-dd-out"), scratch_path(spark, "stream-dd-ckpt")
    lk = lx.prepare_lookup(fixtures.derived_dictionary(spark, sf_dir))
    start_rowwise_report_stream(spark, table_source(f"{sf_dir.rstrip('/')}/documents.parquet"), sink, ckpt, lk).awaitTermination()
    return read_stream_output(spark, sink)  # a lookup beyond its broadcast bound is joined, in folders of batches


def q_report_stream_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 over a change of dictionary: even ids arrive under version 1 (the fixture dictionary), the others after
    version 2 (the derived one) is published and the stream started again."""
    from lexiscope.streaming.report_stream import publish_dictionary, read_stream_output, start_versioned_report_stream
    source, sink, ckpt, words, records = (scratch_path(spark, f"stream-v-{n}") for n in ("in", "out", "ckpt", "words", "records"))
    docs, even = _docs(spark, sf_dir), F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    for i, (part, make) in enumerate(((even, lambda: fixtures.fixture_dictionary(spark)),
                                      (~even, lambda: fixtures.derived_dictionary(spark, sf_dir)))):
        publish_dictionary(make(), words)
        docs.where(part).write.parquet(f"{source}/arrival={i}")
        start_versioned_report_stream(spark, f"{source}/*", sink, ckpt, words, records).awaitTermination()
    return read_stream_output(spark, sink)


QUERIES = {
    "lexicon_signals": q_lexicon_signals,
    "report_flat": q_report_flat,
    "report_flat_bucketed": q_report_flat_bucketed,
    "lexicon_signals_shuffled": q_lexicon_signals_shuffled,
    "lexicon_signals_derived": q_lexicon_signals_derived,
    "lexicon_signals_rowwise": q_lexicon_signals_rowwise,
    "report_nested_json": q_report_nested_json,
    "report_json_text": q_report_json_text,
    "report_checks": q_report_checks,
    "token_tags": q_token_tags,
    "tag_lists": q_tag_lists,
    "rule_based_labels": q_rule_based_labels,
    "dictionary_profile": q_dictionary_profile,
    "dictionary_log": q_dictionary_log,
    "bias_flag_rate": q_bias_flag_rate,
    "standardised_sources": q_standardised_sources,
    "stitched": q_stitched,
    "clean_pages": q_clean_pages,
    "strip_markup_pages": q_strip_markup_pages,
    "ascii_fold_documents": q_ascii_fold_documents,
    "pairs_light_clean": q_pairs_light_clean,
    "label_codes": q_label_codes,
    "input_guard": q_input_guard,
    "prompted_articles": q_prompted_articles,
    "seeded_shuffle": q_seeded_shuffle,
    "seeded_subset": q_seeded_subset,
    "fraction_sample": q_fraction_sample,
    "train_test_split": q_train_test_split,
    "train_val_test_split": q_train_val_test_split,
    "stratified_split": q_stratified_split,
    "split_counts": q_split_counts,
    "class_weights": q_class_weights,
    "confusion_matrix": q_confusion_matrix,
    "classification_metrics": q_classification_metrics,
    "per_row_results": q_per_row_results,
    "rouge_n_pairs": q_rouge_n_pairs,
    "rouge_n_mean": q_rouge_n_mean,
    "rouge_l_pairs": q_rouge_l_pairs,
    "rouge_stemmed": q_rouge_stemmed,
    "rouge_bootstrap": q_rouge_bootstrap,
    "summary_checks": q_summary_checks,
    "stub_summaries": q_stub_summaries,
    "summary_stability": q_summary_stability,
    "log_series": q_log_series,
    "loss_moving_average": q_loss_moving_average,
    "newest_training_logs": q_newest_training_logs,
    "epoch_mean_loss": q_epoch_mean_loss,
    "epoch_last_eval": q_epoch_last_eval,
    "best_run": q_best_run,
    "tfidf_features": q_tfidf_features,
    "rff_features": q_rff_features,
    "rbf_svm_predictions": q_rbf_svm_predictions,
    "model_classifier_signals": q_model_classifier_signals,
    "softmax_from_counts": q_softmax_from_counts,
    "svm_predictions": q_svm_predictions,
    "svm_metrics": q_svm_metrics,
    "model_roundtrip": q_model_roundtrip,
    "csv_sources_stitched": q_csv_sources_stitched,
    "csv_pairs_by_split": q_csv_pairs_by_split,
    "tag_list_text_roundtrip": q_tag_list_text_roundtrip,
    "reports_json_roundtrip": q_reports_json_roundtrip,
    "run_metrics_roundtrip": q_run_metrics_roundtrip,
    "csv_pair_file": q_csv_pair_file,
    "dictionary_csv_profile": q_dictionary_csv_profile,
    "text_corpus_reports": q_text_corpus_reports,
    "report_stream": q_report_stream,
    "report_stream_rowwise": q_report_stream_rowwise,
    "report_stream_derived": q_report_stream_derived,
    "report_stream_versioned": q_report_stream_versioned,
}
