"""ROUGE scores and summary checks.

ROUGE-1/2 are relational: both texts are tokenised and turned into n-gram
arrays on the row, exploded with a side flag, and counted per
``(pair, n, gram)``.  The pair rows are dealt by their key before that, so both
aggregates run where the pair lies and no gram is shuffled.  ROUGE-L/Lsum need the tokens of a
longest common subsequence under the public scorer's tie rule; a small Arrow UDF finds them by bit vectors,
all else is expressions.  Stems (:func:`stemmed`) are made once for each distinct word and joined back, and the
bootstrap aggregate (:func:`bootstrap`) is one map-side sum.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiscope.functions import stems
from lexiscope.functions.hashing import hex_slice_int
from lexiscope.session import cut_lineage

# Summary-check limits (fixed values of the reference's checks).
MIN_SUMMARY_TOKENS = 8
MAX_SUMMARY_TOKENS = 142
MAX_COMPRESSION = 0.85
ROUGE1_FLOOR = 0.20
ROUGE2_FLOOR = 0.05


def rouge_tokens(text: Column) -> Column:
    """Default ROUGE tokeniser: lower, non ``[a-z0-9]`` runs become spaces, split."""
    norm = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    return F.filter(F.split(norm, " "), lambda t: t != "")


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams of a token array (n = 1 or 2)."""
    if n == 1:
        return tokens
    if n == 2:
        tail = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))
        # zip_with pads the shorter side with nulls; concat of a null is null.
        joined = F.zip_with(tokens, tail, lambda a, b: F.concat(a, F.lit(" "), b))
        return F.filter(joined, lambda g: g.isNotNull())
    raise ValueError("n must be 1 or 2")


def _fmeasure(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


#: Bytes of text whose n-grams one task counts.
TASK_BYTES = 2 << 20


def rouge_n(pairs: DataFrame, key_cols: list[str], pred_col: str, ref_col: str,
            orders: tuple[int, ...] = (1, 2), tokenise: Callable[[Column], Column] = rouge_tokens) -> DataFrame:
    """Per pair ``rouge{n}_p/_r/_f`` for each order (pairs with no tokens score 0).

    ``tokenise`` turns a text column into an array of tokens (a stemmer can be plugged in there).
    The short pair rows are dealt by pair once; their n-grams never move.  A task holds the counts of its pairs, so the
    rows (cut from their lineage, for their volume) are dealt to one task for each ``TASK_BYTES`` of text.
    """
    texts = cut_lineage(pairs.select(*key_cols, F.col(pred_col).alias("tp"), F.col(ref_col).alias("tr")))
    size = F.coalesce(F.octet_length("tp"), F.lit(0)).cast("long") + F.coalesce(F.octet_length("tr"), F.lit(0))
    volume = texts.agg(F.sum(size)).first()[0] or 0
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-volume // TASK_BYTES))
    toks = texts.repartition(tasks, *key_cols).select(
        *key_cols, tokenise(F.col("tp")).alias("tp"), tokenise(F.col("tr")).alias("tr"))
    grams = F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(side).alias("side"), ngrams(F.col(col), n).alias("g"))
        for n in orders for side, col in (("p", "tp"), ("r", "tr"))])
    exploded = (toks.select(*key_cols, F.explode(grams).alias("x"))
                .select(*key_cols, F.col("x.n").alias("n"), F.col("x.side").alias("side"),
                        F.explode_outer("x.g").alias("g")))
    per_gram = exploded.groupBy(*key_cols, "n", "g").agg(
        F.count_if((F.col("side") == "p") & F.col("g").isNotNull()).alias("cp"),
        F.count_if((F.col("side") == "r") & F.col("g").isNotNull()).alias("cr"))
    aggs = []
    for n in orders:
        sel = F.col("n") == n
        aggs += [F.sum(F.when(sel, F.least("cp", "cr"))).alias(f"o{n}"),
                 F.sum(F.when(sel, F.col("cp"))).alias(f"np{n}"),
                 F.sum(F.when(sel, F.col("cr"))).alias(f"nr{n}")]
    per_pair = per_gram.groupBy(*key_cols).agg(*aggs)
    out = [F.col(c) for c in key_cols]
    for n in orders:
        p = F.col(f"o{n}") / F.greatest(F.col(f"np{n}"), F.lit(1))
        r = F.col(f"o{n}") / F.greatest(F.col(f"nr{n}"), F.lit(1))
        out += [p.alias(f"rouge{n}_p"), r.alias(f"rouge{n}_r"), _fmeasure(p, r).alias(f"rouge{n}_f")]
    return per_pair.select(*out)


# ---- ROUGE-L / Lsum (LCS) -------------------------------------------------------


class BitLcs:
    """Longest common subsequence of a reference and a candidate by match masks and carries.

    Bit ``i`` of the state is 0 where the DP table steps up between reference tokens ``i`` and ``i + 1``; a candidate
    token changes the whole state by one addition (its carries) and one difference.  Only every ``stride``-th
    state is kept; those between are made again while stepping back, so memory grows with the
    reference's length times the root of the candidate's, in bits.
    """

    def __init__(self, ref: list[str], cand: list[str]):
        self.ref, self.cand = ref, cand
        self.full = (1 << len(ref)) - 1
        self.masks: dict[str, int] = {}
        wanted = set(cand)
        for i, t in enumerate(ref):
            if t in wanted:
                self.masks[t] = self.masks.get(t, 0) | 1 << i
        self.stride = max(1, math.isqrt(len(cand)))

    def _after(self, state: int, token: str) -> int:
        hit = state & self.masks.get(token, 0)
        return ((state + hit) | (state - hit)) & self.full if hit else state

    def length(self) -> int:
        state = self.full
        for t in self.cand:
            state = self._after(state, t)
        return len(self.ref) - state.bit_count()

    def positions(self) -> list[int]:
        """Reference positions of one LCS.  Ties as in the public scorer: from the end, equal tokens are taken, else the
        candidate is stepped back where that keeps more, else the reference."""
        kept, state = [self.full], self.full
        for j, t in enumerate(self.cand, 1):
            state = self._after(state, t)
            if j % self.stride == 0:
                kept.append(state)
        out, i, j, block, states = [], len(self.ref), len(self.cand), -1, []
        while i and j:
            if self.ref[i - 1] == self.cand[j - 1]:
                out.append(i - 1)
                i, j = i - 1, j - 1
                continue
            if j // self.stride != block:
                block = j // self.stride
                states = [kept[block]]
                for t in self.cand[block * self.stride:(block + 1) * self.stride - 1]:
                    states.append(self._after(states[-1], t))
            if states[j % self.stride] >> (i - 1) & 1:
                i -= 1
            else:
                j -= 1
        return out


def lcs_length(a: list[str], b: list[str]) -> int:
    return BitLcs(a, b).length()


def union_hits(ref: list[list[str]], cand: list[list[str]]) -> int:
    """Tokens of the union of each reference sentence's LCS with all candidate sentences, each token at most as
    often as the candidate has it."""
    found: Counter = Counter()
    for r in ref:
        union = {i for c in cand for i in BitLcs(r, c).positions()}
        found.update(r[i] for i in union)
    has = Counter(t for c in cand for t in c)
    return sum(min(n, has[t]) for t, n in found.items())


_LCS = T.StructType([T.StructField("lcs", T.LongType()), T.StructField("hits", T.LongType())])


@F.pandas_udf(_LCS)
def lcs_counts(ref: pd.Series, cand: pd.Series) -> pd.DataFrame:
    """LCS length over all tokens and union-LCS hits over sentences; texts are normalised lines of tokens."""
    rows = []
    for r, c in zip(ref, cand):
        r, c = [line.split() for line in r.split("\n")], [line.split() for line in c.split("\n")]
        rows.append((lcs_length(sum(r, []), sum(c, [])), union_hits(r, c)))
    return pd.DataFrame(rows, columns=["lcs", "hits"], dtype="int64")


def rouge_lines(text: Column) -> Column:
    """Lines of space-separated ROUGE tokens (lines are the sentences of ROUGE-Lsum); empty for null."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9\\n]+", " ")


def rouge_l(pairs: DataFrame, key_cols: list[str], pred_col: str, ref_col: str) -> DataFrame:
    """Per pair ROUGE-L and ROUGE-Lsum F-measures (row-local, no shuffle).

    Only the subsequences are found in Python (an Arrow UDF of bit-vector steps); tokens and scores are expressions."""
    lines = pairs.select(*key_cols, rouge_lines(F.col(pred_col)).alias("p"), rouge_lines(F.col(ref_col)).alias("r"))
    sized = lines.select(*key_cols, lcs_counts("r", "p").alias("x"), F.size(rouge_tokens(F.col("p"))).alias("np"),
                         F.size(rouge_tokens(F.col("r"))).alias("nr"))

    def score(hits: Column) -> Column:
        return _fmeasure(hits / F.greatest("np", F.lit(1)), hits / F.greatest("nr", F.lit(1)))

    return sized.select(*key_cols, score(F.col("x.lcs")).alias("rougeL_f"), score(F.col("x.hits")).alias("rougeLsum_f"))


# ---- stems -----------------------------------------------------------------------

#: Words (distinct) up to which their stems are broadcast, and over how many keys a word is dealt beyond.
MAX_BROADCAST_STEMS, STEM_SALTS = 2_000_000, 32


def stemmed(pairs: DataFrame, key_cols: list[str], text_cols: list[str],
            max_broadcast: int = MAX_BROADCAST_STEMS) -> DataFrame:
    """``pairs`` with every text as lines of stemmed ROUGE tokens, for :func:`rouge_n` and :func:`rouge_l`.

    Each distinct word is stemmed once (:func:`lexiscope.functions.stems.porter`); tokens find their stem by a
    broadcast join, or, for more than ``max_broadcast`` words, by a join in which no word is one key.  A
    text's tokens come together again by its key, which must be unique.
    """
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("side"), rouge_lines(F.col(c)).alias("t")) for c in text_cols]))
    lines = pairs.select(*key_cols, sides.alias("s")).select(
        *key_cols, "s.side", F.posexplode(F.split("s.t", "\n")).alias("line", "t"))
    words = lines.select(*key_cols, "side", "line", F.posexplode_outer(rouge_tokens(F.col("t"))).alias("pos", "word"))
    words = cut_lineage(words)
    known = cut_lineage(stems.porter(words.select("word").where("word is not null").distinct(), "word", "stem"))
    if known.count() <= max_broadcast:
        joined = words.join(F.broadcast(known), "word", "left")
    else:
        place = F.xxhash64(*key_cols, "side", "line", "pos")
        salt = F.when(F.col("word").isNull(), place).otherwise(F.pmod(place, F.lit(STEM_SALTS)))
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(STEM_SALTS - 1).cast("long"))))
        joined = words.withColumns({"salt": salt, "word": F.coalesce("word", F.lit(""))}).join(
            salted.hint("merge"), ["word", "salt"], "left")
    per_line = joined.groupBy(*key_cols, "side", "line").agg(
        F.array_sort(F.collect_list(F.struct("pos", "stem"))).alias("x"))  # one line of one text
    whole = per_line.groupBy(*key_cols).agg(*[F.array_sort(F.collect_list(
        F.when(F.col("side") == c, F.struct("line", "x")))).alias(c) for c in text_cols])
    return whole.select(*key_cols, *[
        F.array_join(F.transform(c, lambda l: F.array_join(F.transform(l["x"], lambda t: t["stem"]), " ")), "\n").alias(c)
        for c in text_cols])


# ---- bootstrap aggregate -----------------------------------------------------------

REPLICATES, CONFIDENCE = 1000, 0.95
#: Scores enter the sums as integers of this many to 1, so their order cannot matter.
SCORE_UNITS = 10 ** 9
#: Replicates that one md5 of a pair serves, by 16 bits each.
PER_HASH = 8


def poisson_steps() -> list[int]:
    """16-bit values from which on a Poisson(1) draw is at least 1, 2, ...: the distribution function times 65536."""
    steps, term, total = [], math.exp(-1), 0.0
    for k in range(1, 9):
        total += term
        steps.append(int(total * 65536))
        term /= k
    return [x for x in steps if x < 65536]


def bootstrap(per_pair: DataFrame, key_cols: list[str], score_cols: list[str], replicates: int = REPLICATES,
              confidence: float = CONFIDENCE, seed: int = 42, places: int = 6) -> DataFrame:
    """A7's aggregate: ``metric, low, mid, high``, percentiles of the replicates' mean scores.

    A Poisson bootstrap: in replicate ``b`` a pair counts as often as a Poisson(1) draw taken from the md5 of seed, key and
    ``b``, so replicates need no pass of their own, do not depend on partitioning and are summed map-side: what
    moves is a few integers for each replicate and task.  ``replicates`` is rounded up to a multiple of ``PER_HASH``.
    Null scores count as 0; no pairs give null percentiles.
    """
    blocks = -(-replicates // PER_HASH)
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols])
    units = [F.round(F.coalesce(F.col(c), F.lit(0.0)) * SCORE_UNITS).cast("bigint").alias(c) for c in score_cols]
    each = per_pair.select(key.alias("k"), *units).select(
        *score_cols, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "k")
    each = each.withColumn("h", F.md5(F.concat_ws(":", F.lit(str(seed)), "block", "k").cast("binary")))
    for i in range(PER_HASH):
        u = hex_slice_int(F.col("h"), 4 * i + 1, 4)
        each = each.withColumn(f"u{i}", u).withColumn(
            f"w{i}", sum((F.when(F.col(f"u{i}") >= t, 1).otherwise(0) for t in poisson_steps()), F.lit(0)).cast("bigint"))
    sums = each.groupBy("block").agg(*[
        F.struct(F.sum(f"w{i}").alias("n"), *[F.sum(F.col(f"w{i}") * F.col(c)).alias(c) for c in score_cols]).alias(f"r{i}")
        for i in range(PER_HASH)])
    means = sums.select(F.explode(F.array(*[f"r{i}" for i in range(PER_HASH)])).alias("r")).where("r.n > 0").select(
        F.explode(F.array(*[F.struct(F.lit(c.removesuffix("_f")).alias("metric"),
                                     (F.col(f"r.{c}") / F.col("r.n") / SCORE_UNITS).alias("mean")) for c in score_cols])
                  ).alias("m")).select("m.*")
    tail = (1 - confidence) / 2
    marks = {"low": tail, "mid": 0.5, "high": 1 - tail}
    return means.groupBy("metric").agg(*[F.round(F.expr(f"percentile(mean, {p!r}D)"), places).alias(name)
                                         for name, p in marks.items()])


def mean_scores(per_pair: DataFrame, cols: list[str], places: int = 3) -> DataFrame:
    """Corpus score = mean over pairs, rounded like the reference's metric table."""
    return per_pair.agg(*[F.round(F.avg(c), places).alias(c.replace("_f", "")) for c in cols])


WORD_SEP = "[ \\t\\n\\r\\f\\x0B]+"


def word_count(text: Column) -> Column:
    """Whitespace-separated words (ASCII whitespace, same class in Spark and DuckDB)."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SEP), lambda t: t != ""))


def summary_checks(df: DataFrame, article_col: str, summary_col: str,
                   scores: DataFrame | None = None, key_cols: list[str] | None = None,
                   max_tokens: int = MAX_SUMMARY_TOKENS) -> DataFrame:
    """One row of check counts; whitespace words stand in for sub-word tokens.

    ``max_tokens``: a summary's length limit (128 for the sentence-level summariser).

    With ``scores`` (per-pair ``rouge1_f``/``rouge2_f`` keyed by ``key_cols``,
    e.g. from :func:`rouge_n`) the corpus means and the ROUGE floor check are
    added; the scores are equi-joined per pair before the single aggregate.
    """
    s_words = word_count(F.col(summary_col))
    a_words = word_count(F.col(article_col))
    stripped = F.trim(F.coalesce(F.col(summary_col), F.lit("")))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(stripped == "").alias("n_empty"),
        F.count_if(s_words < MIN_SUMMARY_TOKENS).alias("n_too_short"),
        F.count_if(s_words > max_tokens).alias("n_too_long"),
        F.count_if(s_words / F.greatest(a_words, F.lit(1)) >= MAX_COMPRESSION)
        .alias("n_not_compressed"),
        F.count_distinct(F.sha2(F.col(summary_col), 256)).alias("n_distinct"),  # digests move, not texts
    ]
    if scores is not None:
        df = df.join(scores.select(*key_cols, "rouge1_f", "rouge2_f"), key_cols, "left")
        aggs += [F.round(F.avg("rouge1_f"), 3).alias("rouge1"),
                 F.round(F.avg("rouge2_f"), 3).alias("rouge2")]
    checks = df.agg(*aggs).withColumn("all_distinct", F.col("n_distinct") == F.col("n"))
    if scores is not None:
        checks = checks.withColumn(
            "rouge_floor_ok", (F.col("rouge1") > ROUGE1_FLOOR) & (F.col("rouge2") > ROUGE2_FLOOR))
    return checks


def stability(run_a: DataFrame, run_b: DataFrame, key_cols: list[str], col: str) -> DataFrame:
    """A10: the same input twice -> how many outputs differ (null-safe)."""
    j = run_a.select(*key_cols, F.col(col).alias("a")).join(
        run_b.select(*key_cols, F.col(col).alias("b")), key_cols)
    return j.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_changed"))
