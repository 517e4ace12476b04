"""Dictionary tagging, vote and bias.

Shape of the batch job (one scan of the text, one small shuffle):

    documents ──posexplode_outer(split(text))──► (doc_id, pos, token)
              ──broadcast LEFT join on upper(token)──► (doc_id, pos, code)
              ──groupBy(doc_id): 8 counts + 7 first positions──► one row per doc

Only ``doc_id`` and fixed-width columns travel through the explode and the
aggregate, so the aggregate stays a hash aggregate with map-side partial
aggregation: at most one partial row per document per task is shuffled,
whatever the document length.  Documents with no kept token still produce a
row (``posexplode_outer`` plus conditional counts), so no join back is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope.functions import text as tx
from lexiscope.functions import word_table

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# --------------------------------------------------------------------------

# Tag priority: the first category with a positive value tags the word.
CATEGORIES = ("positive", "negative", "uncertainty", "litigious",
              "strong_modal", "weak_modal", "constraining")
CNS = "cns"
# Tag -> tri-class label.
TAG_TO_CLASS = {
    "positive": "positive",
    "negative": "negative",
    "litigious": "negative",
    "constraining": "negative",
    "uncertainty": "neutral",
    "strong_modal": "neutral",
    "weak_modal": "neutral",
    "neutral": "neutral",
    "cns": "neutral",
}
BIAS_CATEGORIES = ("uncertainty", "litigious", "constraining")
BIAS_THRESHOLD = 0.15
ROUND_PLACES = 4

# Integer codes used inside the job: 1..7 = CATEGORIES, 0 = cns, -1 = dropped.
CODE = {c: i + 1 for i, c in enumerate(CATEGORIES)}
CODE_CNS = 0
CODE_DROP = -1

STOPWORD_MODES = ("before_lookup", "in_dictionary")
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
#: A lookup up to so many bytes may stand in a plan as literals.
MAX_LITERAL_BYTES = 1 << 20
#: Keys over which each word is dealt where the lookup is too large to broadcast.
SALTS = 32


# --------------------------------------------------------------------------
# Dictionary projection and normalisation.
# --------------------------------------------------------------------------


def project_dictionary(dictionary: DataFrame) -> DataFrame:
    """S6 projection: upper-cased word + the seven categories, nulls as 0, INT."""
    cols = {c.lower(): c for c in dictionary.columns}
    missing = [c for c in ("word",) + CATEGORIES if c not in cols]
    if missing:
        raise ValueError(f"dictionary is missing columns: {missing}")
    return dictionary.select(
        F.upper(F.col(cols["word"]).cast("string")).alias("word"),
        *[F.coalesce(F.col(cols[c]).cast("double").cast("int"), F.lit(0)).alias(c) for c in CATEGORIES],
    )


def tag_of_categories(prefix: str = "") -> Column:
    """L1: first category with a value ``> 0`` in priority order, else null."""
    expr = None
    for cat in CATEGORIES:
        cond = F.col(prefix + cat) > 0
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr


def normalise_dictionary(dictionary: DataFrame) -> DataFrame:
    """L1: ``(word, tag)``; tag null for words in the dictionary that never tag."""
    return project_dictionary(dictionary).select("word", tag_of_categories().alias("tag"))


@dataclass(frozen=True)
class Lookup:
    """Prepared, size-checked lookup table ``(word, code)`` for the tagger."""

    table: DataFrame
    rows: int
    broadcast: bool
    stopword_mode: str
    approx_bytes: int = 0

    def join_side(self) -> DataFrame:
        return F.broadcast(self.table) if self.broadcast else self.table


def prepare_lookup(dictionary: DataFrame, stopword_mode: str = "before_lookup",
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> Lookup:
    """Reduce the dictionary to the words that change a tag, check it, size it.

    * ``before_lookup`` (interactive chain): stopwords are dropped before lookup.
    * ``in_dictionary`` (batch tagger): a stopword is dropped only if it is a
      dictionary word; otherwise it is ``cns``.

    Untagged dictionary words behave like unknown words (``cns``), so only
    tagged words and the stopword entries are kept: at most the tagged part of
    the dictionary plus 121 rows.  Words must be unique after upper-casing,
    which is checked here with one small aggregate over the dictionary.
    """
    if stopword_mode not in STOPWORD_MODES:
        raise ValueError(f"stopword_mode must be one of {STOPWORD_MODES}")
    norm = normalise_dictionary(dictionary)
    stop = F.col("word").isin(list(tx.STOPWORDS))
    code = F.when(stop, F.lit(CODE_DROP))
    for cat in CATEGORIES:
        code = code.when(F.col("tag") == cat, F.lit(CODE[cat]))
    table = norm.where(F.col("tag").isNotNull() | stop).select(
        "word", code.cast("int").alias("code"))
    # In ``before_lookup`` mode stopwords outside the dictionary are dropped
    # by an InSet test in the tagger, so the table is the same in both modes.
    kept = F.col("tag").isNotNull() | stop
    check = (norm.agg(F.count(F.lit(1)).alias("n"),
                      F.count_distinct("word").alias("d"),
                      F.count_if(kept).alias("kept"),
                      # UTF-8 bytes of the kept words + the int code + row overhead
                      F.sum(F.when(kept, F.octet_length("word") + 24)).alias("bytes"))
             .first())
    if check["n"] != check["d"]:
        raise ValueError("dictionary words are not unique after upper-casing")
    rows, size = int(check["kept"]), int(check["bytes"] or 0)
    fits = rows <= max_broadcast_rows and size <= max_broadcast_bytes
    return Lookup(table=table, rows=rows, broadcast=fits, stopword_mode=stopword_mode,
                  approx_bytes=size)


# --------------------------------------------------------------------------
# L3: token tagging (long form).
# --------------------------------------------------------------------------


def _tag_code(lookup: Lookup) -> Column:
    """Code of an exploded token after the lookup join (null = not a token)."""
    token = F.col("token")
    expr = F.when(token.isNull() | ~tx.is_word(token), F.lit(None).cast("int"))
    if lookup.stopword_mode == "before_lookup":
        expr = expr.when(F.col("_u").isin(list(tx.STOPWORDS)), F.lit(None).cast("int"))
    expr = expr.when(F.col("code") == CODE_DROP, F.lit(None).cast("int"))
    return expr.otherwise(F.coalesce(F.col("code"), F.lit(CODE_CNS)))


def _looked_up(tokens: DataFrame, lookup: Lookup, id_col: str) -> DataFrame:
    """``tokens`` with their word's ``code``, by broadcast or, beyond its bound, a shuffled join.

    In the shuffled join no word is one key: each is dealt over ``SALTS`` keys, to which the
    lookup is repeated, and rows that the lookup cannot change get keys of their own.
    """
    if lookup.broadcast:
        return tokens.join(lookup.join_side(), F.col("_u") == F.col("word"), "left")
    settled = F.col("token").isNull() | ~tx.is_word(F.col("token"))
    if lookup.stopword_mode == "before_lookup":
        settled = settled | F.col("_u").isin(list(tx.STOPWORDS))
    place = F.xxhash64(id_col, "pos")
    dealt = (tokens.withColumn("_k", F.when(settled, "").otherwise(F.col("_u")))
             .withColumn("_s", F.when(settled, place).otherwise(F.pmod(place, F.lit(SALTS)))))
    salted = lookup.join_side().withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    same = (F.col("_k") == F.col("word")) & (F.col("_s") == F.col("salt"))
    return dealt.join(salted.hint("merge"), same, "left")


def tag_tokens(docs: DataFrame, lookup: Lookup, id_col: str = "doc_id",
               text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Exploded, tagged tokens: ``(id, *carry, pos, token, code)``; code null = dropped.

    Pieces that are no word are left out before the lookup, but for a document's
    first one: every document keeps a row.  The upper-cased token is projected once
    and serves both as the join key and for the stopword test.
    """
    exploded = docs.select(
        F.col(id_col), *[F.col(c) for c in carry],
        F.posexplode_outer(tx.split_tokens(F.col(text_col))).alias("pos", "token"),
    ).where(tx.is_word(F.col("token")) | (F.coalesce("pos", F.lit(0)) == 0))
    joined = _looked_up(exploded.withColumn("_u", F.upper(F.col("token"))), lookup, id_col)
    return joined.select(id_col, *carry, "pos", "token", _tag_code(lookup).alias("code"))


def code_to_tag(code: Column) -> Column:
    names = F.array(*[F.lit(CNS)] + [F.lit(c) for c in CATEGORIES])
    return F.element_at(names, code + 1)


def token_tags(docs: DataFrame, lookup: Lookup, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """L3 output: ``(doc_id, pos, token, tag)`` for every kept token."""
    return (tag_tokens(docs, lookup, id_col, text_col)
            .where(F.col("code").isNotNull())
            .select(id_col, "pos", "token", code_to_tag(F.col("code")).alias("tag")))


def tag_lists(docs: DataFrame, lookup: Lookup, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """L4: ordered ``ARRAY<STRING>`` of tags (with ``cns``) per document.

    The output is as large as the tag stream itself, so shuffling the tags
    once (as small ``(pos, code)`` structs) is proportional to the result.
    """
    tagged = tag_tokens(docs, lookup, id_col, text_col)
    agg = tagged.groupBy(id_col).agg(
        F.array_sort(F.collect_list(
            F.when(F.col("code").isNotNull(), F.struct("pos", "code")))).alias("pc"))
    return agg.select(id_col, F.transform("pc", lambda e: code_to_tag(e["code"]))
                      .alias("sentiment_list"))


# --------------------------------------------------------------------------
# Counts, vote, class, bias.
# --------------------------------------------------------------------------


def count_columns() -> list[Column]:
    """Aggregate expressions: n_<tag>, n_cns, first_<tag> (all fixed-width)."""
    code = F.col("code")
    aggs = [F.count_if(code == CODE[c]).alias(f"n_{c}") for c in CATEGORIES]
    aggs.append(F.count_if(code == CODE_CNS).alias("n_cns"))
    aggs += [F.min(F.when(code == CODE[c], F.col("pos"))).alias(f"first_{c}")
             for c in CATEGORIES]
    return aggs


def tag_counts(docs: DataFrame, lookup: Lookup, id_col: str = "doc_id",
               text_col: str = "text", carry_max: tuple[str, ...] = (), unique_ids: bool = False) -> DataFrame:
    """One row per document with the eight counts and first positions.

    ``carry_max`` names fixed-width per-document columns (e.g. a classifier's
    label id and confidence) that ride through the aggregate with ``max``.  ``unique_ids``: an id of several
    rows fails the job; the same aggregate counts each document's first pieces.
    """
    tagged = tag_tokens(docs, lookup, id_col, text_col, carry=carry_max)
    rows = F.count_if(F.coalesce("pos", F.lit(0)) == 0)
    counts = tagged.groupBy(id_col).agg(
        *count_columns(), *[F.max(c).alias(c) for c in carry_max], *([rows.alias("_rows")] if unique_ids else []))
    if not unique_ids:
        return counts
    twice = F.raise_error(F.concat(F.lit(f"{id_col} is not unique: "), F.col(id_col).cast("string"))).cast("bigint")
    checked = F.when(F.col("_rows") > 1, twice).otherwise(F.col("n_cns"))
    return counts.withColumn("n_cns", checked).drop("_rows")


def vote_tag() -> Column:
    """Most frequent tag; ties go to the tag seen first in the text."""
    cands = [F.when(F.col(f"n_{c}") > 0,
                    F.struct(F.col(f"n_{c}").alias("n"),
                             (-F.col(f"first_{c}")).alias("neg_first"),
                             F.lit(c).alias("tag")))
             for c in CATEGORIES]
    return F.greatest(*cands)["tag"]


def tri_class(tag: Column, litigious: str = "negative") -> Column:
    """Tag -> positive/negative/neutral; ``litigious='drop'`` gives null.

    No tag (no votes) is neutral.  A 9-entry literal map is a constant-size scan.
    """
    if litigious not in ("negative", "drop"):
        raise ValueError("litigious must be 'negative' or 'drop'")
    pairs = []
    for t, cls in TAG_TO_CLASS.items():
        pairs += [F.lit(t), F.lit(None).cast("string") if (t == "litigious" and litigious == "drop")
                  else F.lit(cls)]
    return F.when(tag.isNull(), F.lit("neutral")).otherwise(F.element_at(F.create_map(*pairs), tag))


def n_tags() -> Column:
    out = F.col(f"n_{CATEGORIES[0]}")
    for c in CATEGORIES[1:]:
        out = out + F.col(f"n_{c}")
    return out


def bias_columns() -> list[Column]:
    """Shares of the three bias tags over non-``cns`` tags, mean, flag.

    The flag uses the unrounded score, summed left to right in double.
    """
    total = F.col("n_tags")
    shares = {c: F.when(total > 0, F.col(f"n_{c}") / total).otherwise(F.lit(0.0))
              for c in BIAS_CATEGORIES}
    score = ((shares["uncertainty"] + shares["litigious"]) + shares["constraining"]) / 3.0
    return [
        *[F.round(shares[c], ROUND_PLACES).alias(c) for c in BIAS_CATEGORIES],
        F.round(score, ROUND_PLACES).alias("bias_score"),
        (score > BIAS_THRESHOLD).alias("bias_flag"),
    ]


def with_vote(counts: DataFrame) -> DataFrame:
    """Adds ``n_tags`` and ``lexicon_tag`` in their own projection, so the vote
    is computed once and not inlined into every expression that reads it."""
    return counts.select("*", n_tags().alias("n_tags"), vote_tag().alias("lexicon_tag"))


def signal_columns(id_col: str = "doc_id", litigious: str = "negative") -> list[Column]:
    """Per-document lexicon + bias columns over a :func:`with_vote` row."""
    return [
        F.col(id_col),
        *[F.col(f"n_{c}") for c in CATEGORIES], F.col("n_cns"), F.col("n_tags"),
        F.col("lexicon_tag"),
        tri_class(F.col("lexicon_tag"), litigious).alias("lexicon_label"),
        *bias_columns(),
    ]


def lexicon_signals(docs: DataFrame, lookup: Lookup, id_col: str = "doc_id",
                    text_col: str = "text", litigious: str = "negative") -> DataFrame:
    """L3->L8 in one job: one row per document."""
    counts = tag_counts(docs, lookup, id_col, text_col)
    return with_vote(counts).select(*signal_columns(id_col, litigious))


def rowwise_codes(lookup: Lookup, text_col: str = "text") -> Column:
    """``ARRAY<INT>`` of tag codes of the kept tokens of one row (0 = cns).

    A small lookup becomes a perfect-hash table of literals (:mod:`lexiscope.functions.word_table`): a hash and two array
    reads a token.  A larger one within its broadcast bound (beyond it the callers explode and join) is packed and broadcast
    to the Python workers, about 24 bytes a word, and never becomes rows or literals on the driver.
    """
    words = F.transform(tx.tokenize(F.col(text_col)), F.upper)
    if lookup.approx_bytes > MAX_LITERAL_BYTES:
        coded, spark = lookup.table, lookup.table.sparkSession
        if lookup.stopword_mode == "before_lookup":  # every stopword is dropped, in the dictionary or not
            stop = spark.createDataFrame([(w, CODE_DROP) for w in tx.STOPWORDS], "word string, code int")
            coded = coded.where(~F.col("word").isin(list(tx.STOPWORDS))).unionByName(stop)
        return word_table.packed_codes(spark, word_table.packed(coded), CODE_CNS, CODE_DROP)(words)
    looked = word_table.codes_of(words, word_table.collect(lookup.table))

    def code_of(x: Column) -> Column:
        found = F.coalesce(x["code"], F.lit(CODE_CNS))
        if lookup.stopword_mode == "before_lookup":
            return F.when(x["t"].isin(list(tx.STOPWORDS)), F.lit(CODE_DROP)).otherwise(found)
        return found

    codes = F.filter(F.transform(looked, code_of), lambda c: c != CODE_DROP)
    return F.coalesce(codes, F.array().cast("array<int>"))


def rowwise_count_columns(codes_col: str = "_c") -> list[Column]:
    """n_<tag>, n_cns, first_<tag> from a codes array (positions among kept tokens)."""
    def equals(k: int):
        return lambda c: c == k  # one-argument lambda: a second one would be the index

    out = [F.size(F.filter(codes_col, equals(CODE[cat]))).cast("bigint").alias(f"n_{cat}")
           for cat in CATEGORIES]
    out.append(F.size(F.filter(codes_col, equals(CODE_CNS))).cast("bigint").alias("n_cns"))
    out += [F.when(F.array_position(codes_col, CODE[cat]) > 0,
                   F.array_position(codes_col, CODE[cat]) - 1).cast("int").alias(f"first_{cat}")
            for cat in CATEGORIES]
    return out


def tag_counts_rowwise(docs: DataFrame, lookup: Lookup, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """L3-L5 without explode, join or shuffle: array functions on each row.

    Same counts and vote as :func:`tag_counts`; suits append-only streaming
    sinks, where an aggregate would need state.  A lookup beyond the broadcast bound is joined instead.
    """
    if not lookup.broadcast:
        return tag_counts(docs, lookup, id_col, text_col)
    staged = docs.select(F.col(id_col), rowwise_codes(lookup, text_col).alias("_c"))
    return staged.select(F.col(id_col), *rowwise_count_columns())


def lexicon_signals_rowwise(docs: DataFrame, lookup: Lookup, id_col: str = "doc_id",
                            text_col: str = "text", litigious: str = "negative") -> DataFrame:
    """Same output as :func:`lexicon_signals`, computed row-wise (no shuffle)."""
    counts = tag_counts_rowwise(docs, lookup, id_col, text_col)
    return with_vote(counts).select(*signal_columns(id_col, litigious))


def counts_map(first_seen: bool = False) -> Column:
    """L5 as ``MAP<STRING,INT>`` of the tags present: in priority order, or with
    ``first_seen`` (needs the ``first_<tag>`` columns) in the order the tags
    first occur in the text, like the reference's counts dict."""
    if first_seen:
        entries = F.array(*[F.struct(F.col(f"first_{c}").alias("p"), F.lit(c).alias("key"),
                                     F.col(f"n_{c}").cast("int").alias("value"))
                            for c in CATEGORIES])
        ordered = F.array_sort(F.filter(entries, lambda e: e["value"] > 0))
        return F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["key"], e["value"])))
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"n_{c}").cast("int").alias("value"))
                        for c in CATEGORIES])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))


# --------------------------------------------------------------------------
# Profiles and rates.
# --------------------------------------------------------------------------

PROFILE_CATEGORIES = CATEGORIES + ("complexity",)


def dictionary_profile(dictionary: DataFrame) -> DataFrame:
    """L2: words, words per category (any non-zero value), doc_count total, stopwords."""
    cols = {c.lower(): c for c in dictionary.columns}
    word = F.upper(F.col(cols["word"]))
    return dictionary.agg(
        F.count(F.lit(1)).alias("n_words"),
        *[F.count_if(F.coalesce(F.col(cols[c]), F.lit(0)) != 0).alias(f"n_{c}")
          for c in PROFILE_CATEGORIES],
        F.sum(F.coalesce(F.col(cols["doc_count"]), F.lit(0))).cast("bigint").alias("total_documents"),
        F.count_if(word.isin(list(tx.STOPWORDS))).alias("n_stopwords"),
    )


# Category order of the dictionary-load log (fixed value).
LOG_CATEGORIES = ("negative", "positive", "uncertainty", "litigious", "strong_modal",
                  "weak_modal", "constraining", "complexity")


def dictionary_log_lines(profile: DataFrame) -> DataFrame:
    """L2 as the dictionary-load log: ``(line_no, line)``, one row per line.

    ``{n:,} words loaded`` then ``{category:13}: {count:8,}`` per category.
    """
    def grouped(c: Column) -> Column:
        return F.format_number(c, 0)

    lines = [F.concat(F.lit("    "), grouped(F.col("n_words")),
                      F.lit(" words loaded in master_dictionary."))]
    lines.append(F.lit("    Sentiment:"))
    for cat in LOG_CATEGORIES:
        lines.append(F.concat(F.lit("      "), F.rpad(F.lit(cat), 13, " "), F.lit(": "),
                              F.lpad(grouped(F.col(f"n_{cat}")), 8, " ")))
    return profile.select(F.posexplode(F.array(*lines)).alias("line_no", "line"))


def flag_rate(signals: DataFrame) -> DataFrame:
    """Flagged / total / percent (one decimal)."""
    return signals.agg(
        F.count_if(F.col("bias_flag")).alias("flagged"),
        F.count(F.lit(1)).alias("total"),
    ).select("flagged", "total",
             F.round(F.when(F.col("total") > 0, F.col("flagged") * 100.0 / F.col("total")), 1)
             .alias("percent"))

