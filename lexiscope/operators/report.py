"""Signal fan-in and the reliability report (J2, R1-R5, ML5 decode).

The batch report job keeps the text in one scan for the lexicon and the
classifier: the classifier's label id and confidence are fixed-width, so they
ride through the tag aggregate (``max``) instead of a second join.  The
summary is a string produced by a separate (usually expensive) model branch,
joined once on the document id (J2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.functions import text as tx
from lexiscope.operators import lexicon as lx

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# --------------------------------------------------------------------------

LOW_CONF_THRESHOLD = 0.55
REASON_DISAGREE = "model_lexicon_disagreement"
REASON_LOW_CONF = "low_finbert_confidence"
REASON_BIAS = "high_lexicon_bias"
# Classifier output index -> label.
CLASS_LABELS = ("positive", "negative", "neutral")

# A classifier adds ``cls_label`` and ``cls_conf`` to ``(id, text)`` rows.
Classifier = Callable[[DataFrame, str, str], DataFrame]
Summariser = Callable[[Column, Column], Column]


def letter_stub_classifier(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Deterministic stand-in for the caller's classifier, computed from the whole text."""
    staged = df.withColumn("_logits", fixtures.letter_logits(F.col(text_col)))
    _, label, conf = softmax_decode(F.col("_logits"))
    return staged.withColumn("cls_label", label).withColumn("cls_conf", conf).drop("_logits")


def model_classifier(logits_udf: Callable[[Column], Column]) -> Classifier:
    """ML4 + ML5: a caller's batch model (text -> logits) decoded by softmax.

    The model output is materialised as a column first: Spark does not allow
    a Python UDF inside the higher-order functions of the decode.
    """
    def classify(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        staged = df.withColumn("_logits", logits_udf(F.col(text_col)))
        _, label, conf = softmax_decode(F.col("_logits"))
        return staged.withColumn("cls_label", label).withColumn("cls_conf", conf).drop("_logits")
    return classify


def lead_stub_summariser(doc_id: Column, text: Column) -> Column:
    return tx.py_strip(fixtures.lead_sentence_summary(text))


def softmax_decode(logits: Column) -> tuple[Column, Column, Column]:
    """ML5: probabilities, arg-max label, confidence (4 places) from ``ARRAY<DOUBLE>``."""
    mx = F.array_max(logits)
    exps = F.transform(logits, lambda x: F.exp(x - mx))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
    probs = F.transform(exps, lambda x: x / total)
    top = F.array_position(probs, F.array_max(probs))
    label = F.element_at(F.array(*[F.lit(x) for x in CLASS_LABELS]), top.cast("int"))
    confidence = F.round(F.element_at(probs, top.cast("int")), lx.ROUND_PLACES)
    return probs, label, confidence


def reliability_columns(model_label: Column, confidence: Column, lexicon_label: Column,
                        bias_flag: Column, bias_score: Column) -> list[Column]:
    """Agreement, ordered reasons, tier."""
    agreement = model_label == lexicon_label
    reasons = F.array_compact(F.array(
        F.when(~agreement, F.lit(REASON_DISAGREE)),
        F.when(confidence < LOW_CONF_THRESHOLD, F.lit(REASON_LOW_CONF)),
        F.when(bias_flag | (bias_score > lx.BIAS_THRESHOLD), F.lit(REASON_BIAS)),
    ))
    n = F.size(reasons)
    tier = F.when(n >= 2, F.lit("low")).when(n == 1, F.lit("medium")).otherwise(F.lit("high"))
    return [agreement.alias("agreement"), tier.alias("reliability"), reasons.alias("reasons")]


def report_table(docs: DataFrame, lookup: lx.Lookup, id_col: str = "doc_id",
                 text_col: str = "text", classifier: Classifier = letter_stub_classifier,
                 summariser: Summariser = lead_stub_summariser,
                 keep_positions: bool = False, prompt: bool = False, unique_ids: bool = False) -> DataFrame:
    """One flat report row per document (arrays kept as arrays).

    ``keep_positions`` keeps the first position of each tag (for the
    reference-format JSON, whose counts follow first occurrence).  ``prompt`` puts the neutral-summary instruction
    (T9) in front of what the summariser reads.  ``unique_ids`` fails on an id of several rows, which the joined
    branches would multiply."""
    doc_id, text = F.col(id_col), F.col(text_col)
    labelled = classifier(docs.select(id_col, text_col), id_col, text_col)
    label_id = F.array_position(F.array(*[F.lit(x) for x in CLASS_LABELS]), F.col("cls_label"))
    scored = labelled.select(id_col, text_col, label_id.cast("int").alias("cls_id"),
                             F.col("cls_conf").cast("double").alias("cls_conf"))
    counts = lx.tag_counts(scored, lookup, id_col, text_col,
                           carry_max=("cls_id", "cls_conf"), unique_ids=unique_ids)
    lex = lx.with_vote(counts).select(
        *lx.signal_columns(id_col), *[f"first_{c}" for c in lx.CATEGORIES],
        F.element_at(F.array(*[F.lit(x) for x in CLASS_LABELS]), F.col("cls_id"))
        .alias("finbert_label"),
        F.round(F.col("cls_conf"), lx.ROUND_PLACES).alias("finbert_confidence"),
    )
    # Summaries are stripped, as the reference's summariser strips its output.
    summaries = docs.select(doc_id, tx.py_strip(summariser(doc_id, tx.with_prompt(text, prompt))).alias("summary"))
    joined = lex.join(summaries, id_col)  # J2: fan-in of the summary branch
    return joined.select(
        id_col, "summary", "finbert_label", "finbert_confidence", "lexicon_label",
        *[f"n_{c}" for c in lx.CATEGORIES], "n_cns", "n_tags",
        *lx.BIAS_CATEGORIES, "bias_score", "bias_flag",
        *reliability_columns(F.col("finbert_label"), F.col("finbert_confidence"),
                             F.col("lexicon_label"), F.col("bias_flag"),
                             F.col("bias_score")),
        *([f"first_{c}" for c in lx.CATEGORIES] if keep_positions else []),
    )


def report_table_rowwise(docs: DataFrame, lookup: lx.Lookup, id_col: str = "doc_id",
                         text_col: str = "text", classifier: Classifier = letter_stub_classifier,
                         summariser: Summariser = lead_stub_summariser) -> DataFrame:
    """R5 with every signal computed on the row: no join, no aggregate, no shuffle.

    Same columns as :func:`report_table`; usable in an append-only stream.
    Needs a lookup within the broadcast bound (:func:`lexicon.rowwise_codes`).
    """
    base = classifier(docs.select(id_col, text_col), id_col, text_col).select(
        id_col, tx.py_strip(summariser(F.col(id_col), F.col(text_col))).alias("summary"),
        F.col("cls_label").alias("finbert_label"),
        F.round(F.col("cls_conf").cast("double"), lx.ROUND_PLACES).alias("finbert_confidence"),
        lx.rowwise_codes(lookup, text_col).alias("_c"))
    counts = base.select(id_col, "summary", "finbert_label", "finbert_confidence",
                         *lx.rowwise_count_columns())
    sig = lx.with_vote(counts).select(
        *lx.signal_columns(id_col), "summary", "finbert_label", "finbert_confidence")
    return sig.select(
        id_col, "summary", "finbert_label", "finbert_confidence", "lexicon_label",
        *[f"n_{c}" for c in lx.CATEGORIES], "n_cns", "n_tags",
        *lx.BIAS_CATEGORIES, "bias_score", "bias_flag",
        *reliability_columns(F.col("finbert_label"), F.col("finbert_confidence"),
                             F.col("lexicon_label"), F.col("bias_flag"), F.col("bias_score")),
    )


def nested_report(flat: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The nested report struct of the reference's schema, per document."""
    report = F.struct(
        F.col("summary").alias("summary"),
        F.struct(F.col("finbert_label").alias("label"),
                 F.col("finbert_confidence").alias("confidence")).alias("finbert"),
        F.struct(F.col("lexicon_label").alias("label"),
                 lx.counts_map(first_seen=all(f"first_{c}" in flat.columns for c in lx.CATEGORIES))
                 .alias("counts"))
        .alias("lexicon"),
        F.struct(*[F.col(c).alias(c) for c in lx.BIAS_CATEGORIES],
                 F.col("bias_score").alias("score"), F.col("bias_flag").alias("flag"))
        .alias("bias"),
        F.col("agreement"), F.col("reliability"), F.col("reasons"),
    )
    return flat.select(id_col, report.alias("report"))


def report_json(nested: DataFrame, id_col: str = "doc_id", pretty: bool = False) -> DataFrame:
    """K2: one JSON object per article; nulls kept, non-ASCII kept."""
    opts = {"ignoreNullFields": "false"}
    if pretty:
        opts["pretty"] = "true"
    return nested.select(id_col, F.to_json(F.col("report"), opts).alias("json"))


# ---- K2 in the reference's text form ---------------------------------------------


def json_string(col: Column) -> Column:
    """JSON string literal as Python's ``json.dumps(ensure_ascii=False)`` writes it.

    Spark's JSON writer escapes the same characters; only the hex digits of
    ``\\u00XX`` escapes differ in case (Python writes them lower-case).
    """
    wrapped = F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
    # ``{"v":<literal>}``: cut the fixed 5-character prefix and the closing
    # brace by position (a regex ``.`` would stop at U+2028 and other line
    # terminators, which JSON leaves unescaped).
    lit = F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)
    for cp in range(0x20):
        upper = f"\\u{cp:04X}"
        if upper != upper.lower():
            lit = F.replace(lit, F.lit(upper), F.lit(upper.lower()))
    return lit


def json_number_4(col: Column) -> Column:
    """Python ``repr`` of a double already rounded to 4 places (fixed notation)."""
    fixed = F.regexp_replace(F.format_string("%.4f", col), "0+$", "")
    return F.when(col.isNull(), F.lit("null")).otherwise(
        F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed))


def _json_bool(col: Column) -> Column:
    return F.when(col.isNull(), F.lit("null")).when(col, F.lit("true")).otherwise(F.lit("false"))


def _kv(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}": '), value)


def report_json_python(flat: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """K2 text identical to the reference's ``json.dumps(report, ensure_ascii=False)``.

    Keys in schema order, ``", "`` / ``": "`` separators, and the tag counts in
    the order the tags first occur in the article (Python dict insertion
    order), recovered from the first positions kept by the tag aggregate.
    """
    missing = [f"first_{c}" for c in lx.CATEGORIES if f"first_{c}" not in flat.columns]
    if missing:
        raise ValueError("report_json_python needs report_table(..., keep_positions=True)")
    firsts = [F.struct(F.col(f"first_{c}").alias("p"), F.lit(c).alias("tag"),
                       F.col(f"n_{c}").alias("n")) for c in lx.CATEGORIES]
    seen = F.array_sort(F.filter(F.array(*firsts), lambda e: e["n"] > 0))
    counts = F.concat(F.lit("{"), F.array_join(F.transform(
        seen, lambda e: F.concat(F.lit('"'), e["tag"], F.lit('": '), e["n"].cast("string"))), ", "),
        F.lit("}"))
    reasons = F.concat(F.lit("["), F.array_join(F.transform(F.col("reasons"), json_string), ", "),
                       F.lit("]"))
    body = F.concat_ws(", ",
        _kv("summary", json_string(F.col("summary"))),
        _kv("finbert", F.concat(F.lit("{"), F.concat_ws(", ",
            _kv("label", json_string(F.col("finbert_label"))),
            _kv("confidence", json_number_4(F.col("finbert_confidence")))), F.lit("}"))),
        _kv("lexicon", F.concat(F.lit("{"), F.concat_ws(", ",
            _kv("label", json_string(F.col("lexicon_label"))), _kv("counts", counts)), F.lit("}"))),
        _kv("bias", F.concat(F.lit("{"), F.concat_ws(", ",
            *[_kv(c, json_number_4(F.col(c))) for c in lx.BIAS_CATEGORIES],
            _kv("score", json_number_4(F.col("bias_score"))),
            _kv("flag", _json_bool(F.col("bias_flag")))), F.lit("}"))),
        _kv("agreement", _json_bool(F.col("agreement"))),
        _kv("reliability", json_string(F.col("reliability"))),
        _kv("reasons", reasons))
    return flat.select(id_col, F.concat(F.lit("{"), body, F.lit("}")).alias("json"))


def report_checks(flat: DataFrame) -> DataFrame:
    """Violations of the report's bounds and closed sets (one row)."""
    unit = lambda c: ~F.col(c).between(0.0, 1.0) | F.col(c).isNull()
    return flat.agg(
        F.count(F.lit(1)).alias("n_reports"),
        F.count_if(unit("finbert_confidence")).alias("bad_confidence"),
        F.count_if(unit("uncertainty") | unit("litigious") | unit("constraining"))
        .alias("bad_shares"),
        F.count_if(unit("bias_score")).alias("bad_score"),
        F.count_if(~F.col("finbert_label").isin(*CLASS_LABELS)
                   | F.col("finbert_label").isNull()).alias("bad_finbert_label"),
        F.count_if(~F.col("lexicon_label").isin(*CLASS_LABELS)
                   | F.col("lexicon_label").isNull()).alias("bad_lexicon_label"),
        F.count_if(~F.col("reliability").isin("high", "medium", "low")).alias("bad_tier"),
    )
