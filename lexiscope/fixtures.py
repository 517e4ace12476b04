"""Inputs the reference does not ship, derived from the given tables.

The reference's dictionary and labelled sets are not public inputs here, so
this module defines stand-ins (see FIXTURES.md): a small fixture lexicon in the
dictionary's 17-column layout, and projections of ``documents``, ``labels``,
``pages``, ``conversations`` and ``events`` into the reference's shapes.
Everything except the lexicon is computed by Spark from the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiscope.functions.hashing import hex_slice_int

# --------------------------------------------------------------------------
# Fixture lexicon (FIXTURES.md section 4).
# --------------------------------------------------------------------------

FIXTURE_CATEGORY_WORDS = {
    "positive": ("TION", "THER", "QUE", "BLE", "THING"),
    "negative": ("ER", "ERIN", "DES", "THAN", "ONED", "ERST"),
    "uncertainty": ("TH", "LA", "OU", "ANON"),
    "litigious": ("HA", "LICENSE", "LICENSED", "ERLY"),
    "strong_modal": ("ED", "DIE"),
    "weak_modal": ("EA", "UN"),
    "constraining": ("ST", "LE", "ANTI", "ER"),
}
# Words that exercise the sign rule and the never-tagging complexity column.
FIXTURE_EXTRA = {
    "RE": {"negative": -2020},
    "NT": {"complexity": 2009},
}
FIXTURE_YEAR = 2009

# Column order of the full dictionary file.
DICTIONARY_COLUMNS = (
    "word", "seq_num", "word_count", "word_proportion", "average_proportion",
    "std_dev", "doc_count", "negative", "positive", "uncertainty", "litigious",
    "strong_modal", "weak_modal", "constraining", "complexity", "syllables",
    "source",
)

DICTIONARY_SCHEMA = T.StructType(
    [T.StructField("word", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("seq_num", "word_count")]
    + [T.StructField(c, T.DoubleType())
       for c in ("word_proportion", "average_proportion", "std_dev")]
    + [T.StructField(c, T.LongType()) for c in ("doc_count",)]
    + [T.StructField(c, T.IntegerType())
       for c in ("negative", "positive", "uncertainty", "litigious",
                 "strong_modal", "weak_modal", "constraining", "complexity",
                 "syllables")]
    + [T.StructField("source", T.StringType())]
)


def fixture_dictionary_rows() -> list[tuple]:
    """Rows of the fixture dictionary in the 17-column layout."""
    entries: dict[str, dict[str, int]] = {}
    for cat, words in FIXTURE_CATEGORY_WORDS.items():
        for w in words:
            entries.setdefault(w, {})[cat] = FIXTURE_YEAR
    for w, cats in FIXTURE_EXTRA.items():
        entries.setdefault(w, {}).update(cats)
    rows = []
    for seq, word in enumerate(sorted(entries), start=1):
        cats = entries[word]
        rows.append((
            word, seq, 1000 * seq, seq / 1e5, seq / 1e5, seq / 1e4, 10 * seq,
            cats.get("negative", 0), cats.get("positive", 0),
            cats.get("uncertainty", 0), cats.get("litigious", 0),
            cats.get("strong_modal", 0), cats.get("weak_modal", 0),
            cats.get("constraining", 0), cats.get("complexity", 0),
            max(1, len(word) // 2), "fixture",
        ))
    return rows


def fixture_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixture_dictionary_rows(), DICTIONARY_SCHEMA)


# Header of the dictionary file (fixed value), in column order.
DICTIONARY_HEADER = (
    "Word", "Seq_num", "Word Count", "Word Proportion", "Average Proportion", "Std Dev",
    "Doc Count", "Negative", "Positive", "Uncertainty", "Litigious", "Strong_Modal",
    "Weak_Modal", "Constraining", "Complexity", "Syllables", "Source",
)


def fixture_dictionary_csv_text() -> str:
    """The fixture dictionary as the reference's CSV (header + 17 columns)."""
    lines = [",".join(DICTIONARY_HEADER)] + [",".join(str(v) for v in r)
                                             for r in fixture_dictionary_rows()]
    return "\n".join(lines) + "\n"


# --------------------------------------------------------------------------
# Stand-in model signals (deterministic; the real models are caller-supplied).
# --------------------------------------------------------------------------

CLASSIFIER_LABELS = ("positive", "negative", "neutral")  # index = class id


#: Letters whose counts in the whole text are the stand-in's logits, in the order of the labels.
CLASSIFIER_LETTERS = ("g", "b", "k")


def letter_logits(text: Column) -> Column:
    """Stand-in classifier output: 4 x each letter's share among the three (a null text has none)."""
    low = F.lower(F.coalesce(text, F.lit("")))
    counts = [F.regexp_count(low, F.lit(x)).cast("double") for x in CLASSIFIER_LETTERS]
    total = F.greatest(counts[0] + counts[1] + counts[2], F.lit(1.0))
    return F.array(*[F.lit(4.0) * c / total for c in counts])


def lead_sentence_summary(text: Column) -> Column:
    """Stand-in summariser (not a model): the first sentence of every paragraph, over the whole text."""
    firsts = F.transform(
        F.split(text, "\n"),
        lambda p: F.trim(F.regexp_extract(p, "^[^.!?]*[.!?]?", 0)),
    )
    return F.array_join(F.filter(firsts, lambda s: s != ""), " ")


# --------------------------------------------------------------------------
# Labelled text and sources derived from documents / labels.
# --------------------------------------------------------------------------

NOISY_PREFIX = "It's <b>won't</b> &amp; 'data ? "


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` inner ``labels``: doc_id, text, numeric label sign(quality - toxic)."""
    from lexiscope.session import read_table
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = read_table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select(
        "doc_id", "text", "source",
        F.signum(F.col("quality") - F.col("toxic")).cast("double").alias("label_num"),
    )


def labelled_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two labelled sources of the standardise job, from documents + labels.

    * sentence source (even ``doc_id``): string labels (`` Positive ``, ``-1``, ``neutral``)
    * headline source (odd ``doc_id``): numeric labels (sign of quality - toxic)

    Every labelled document is one row, its text behind the noisy prefix.  Beside them, by
    rule, stand added rows with ids of their own, ``-1 - (3 doc_id + k)``: one without a text (``doc_id % 17 = 0``),
    one with a blank text (``% 19 = 0``), one with an unknown label (``% 23 = 0``).
    """
    doc_id = F.col("doc_id")
    noisy = F.concat(F.lit(NOISY_PREFIX), F.col("text"))

    def row(key: Column, text: Column, unknown: bool) -> Column:
        return F.struct(key.alias("doc_id"), text.alias("text"), F.lit(unknown).alias("unknown"))

    def added(k: int) -> Column:
        return -1 - (doc_id * 3 + k)

    rows = F.array(row(doc_id, noisy, False),
                   F.when(doc_id % 17 == 0, row(added(0), F.lit(None).cast("string"), False)),
                   F.when(doc_id % 19 == 0, row(added(1), F.lit("   "), False)),
                   F.when(doc_id % 23 == 0, row(added(2), noisy, True)))
    lab = labelled_documents(spark, sf_dir).select(
        (doc_id % 2 == 0).alias("even"), "label_num", F.explode(F.array_compact(rows)).alias("r")).select(
        "even", "label_num", "r.*")
    str_label = (F.when(F.col("unknown"), F.lit("unknown"))
                 .when(F.col("label_num") > 0, F.lit(" Positive "))
                 .when(F.col("label_num") < 0, F.lit("-1"))
                 .otherwise(F.lit("neutral")))
    num_label = F.when(~F.col("unknown"), F.col("label_num"))
    sentences = lab.where("even").select("doc_id", str_label.alias("sentiment"), F.col("text").alias("data"))
    headlines = lab.where("NOT even").select(
        "doc_id", F.col("text").alias("Title"), num_label.alias("Global Sentiment"))
    return sentences, headlines


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn = article, the next assistant turn = summary (equi-join on turn + 1)."""
    from lexiscope.session import read_table
    conv = read_table(spark, sf_dir, "conversations")
    user = conv.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("article"))
    asst = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("summary"))
    return user.join(asst, ["conv_id", "turn"])


def truth_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label)``: the numeric label of ``labels`` normalised."""
    from lexiscope.session import read_table
    labels = read_table(spark, sf_dir, "labels")
    d = F.col("quality") - F.col("toxic")
    return labels.select("doc_id", F.when(d > 0, F.lit("positive")).when(d < 0, F.lit("negative"))
                         .when(d == 0, F.lit("neutral")).alias("label"))


LOG_EPOCH_ORIGIN = "2024-01-01 00:00:00"


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a training log: run = user, epoch = days since the origin,
    ``eval_loss`` on error events, ``loss`` on the others, ``eval_accuracy`` and ``eval_rougeL`` the event's ``k`` in
    hundredths on error and signup events; order = (ts, event_id)."""
    from lexiscope.session import read_table
    ev = read_table(spark, sf_dir, "events")
    # Wall-clock difference of two TIMESTAMP_NTZ values: no session time zone involved.
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{LOG_EPOCH_ORIGIN}', "
                    f"CAST(ts AS TIMESTAMP_NTZ))")
    epoch = micros / F.lit(86_400_000_000.0)
    is_eval = F.col("event_type") == "error"
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.col("user_id").alias("run"), "ts", "event_id", epoch.alias("epoch"),
        F.when(~is_eval, F.col("value")).alias("loss"),
        F.when(is_eval, F.col("value")).alias("eval_loss"),
        F.when(is_eval, k / 100.0).alias("eval_accuracy"),
        F.when(F.col("event_type") == "signup", k / 100.0).alias("eval_rougeL"))


def run_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-run test metric: mean value of purchase events (null when none)."""
    from lexiscope.session import read_table
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(F.col("user_id").alias("run")).agg(
        F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("score"))


# Derived dictionary: every distinct token of ``documents`` (upper case),
# categories by a hash rule, so tagging runs against a realistically large
# lexicon whose size grows with the corpus.  Bucket -> categories (fixed rule):
DERIVED_BUCKETS = 16
DERIVED_RULE = {
    0: ("positive",), 1: ("negative",), 2: ("uncertainty",), 3: ("litigious",),
    4: ("strong_modal",), 5: ("weak_modal",), 6: ("constraining",),
    7: ("negative", "constraining"), 8: ("complexity",),
}


def derived_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary in the 7-category layout built by Spark from the corpus vocabulary."""
    from lexiscope.functions import text as tx
    from lexiscope.session import cut_lineage, read_table
    docs = read_table(spark, sf_dir, "documents")
    # The words of a document once each, so that a count is a number of documents.
    words = F.array_distinct(F.transform(F.filter(tx.split_tokens(F.col("text")), tx.is_word), F.upper))
    words = docs.select(F.explode(words).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("doc_count"))
    bucket = hex_slice_int(F.md5(F.col("word")), 1) % DERIVED_BUCKETS
    cats = {}
    for b, names in DERIVED_RULE.items():
        for n in names:
            cats.setdefault(n, []).append(b)
    cols = [F.when(bucket.isin(cats.get(c, [])), F.lit(FIXTURE_YEAR)).otherwise(F.lit(0))
            .cast("int").alias(c)
            for c in ("positive", "negative", "uncertainty", "litigious", "strong_modal",
                      "weak_modal", "constraining", "complexity")]
    # Materialised once: its size is checked before it is broadcast, and the
    # tagging job then reads the checkpoint instead of re-deriving it.
    return cut_lineage(words.select("word", *cols, "doc_count"))
