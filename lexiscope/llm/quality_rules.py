"""Quality rules with risk-controlled thresholds.

Every text gets base signals.  A rule compares a ratio of signals with a cutoff from a fixed
grid.  On labelled holdouts (``quality`` 1: good), each (stratum, rule, cutoff) is a hypothesis
"this cutoff rejects at least ``alpha / rules`` of the good documents of the stratum", tested by the
exact binomial tail P(Bin(n, alpha / rules) <= false rejections).  A cutoff is certified when its tail is at
most ``delta`` divided by the number of hypotheses (Bonferroni), so with probability
1 - ``delta`` every certified cutoff keeps its bound, whichever one is then chosen.  Per
stratum and rule the certified cutoff that rejects most bad documents is taken (the loosest
of equals); without one the rule rejects nothing there.

Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import WHITE, ready, words_of, written

ALPHA = 0.02
DELTA = 0.05
WINDOW = 8
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"
#: Strata up to which the chosen cutoffs are broadcast.
BROADCAST_STRATA = 100_000

#: Rule name -> (value, cutoffs); a document is rejected if its value is above the cutoff.
RULES = {
    "symbols": ("n_symbols / n_words", [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]),
    "dup_lines": ("n_dup_lines / n_lines", [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]),
    "repeats": ("n_repeat_words / n_words", [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3]),
    "long_words": ("word_chars / n_words", [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0]),
    "short_words": ("- word_chars / n_words", [-5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0, -1.5]),
}


def signals(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum, n_words, word_chars, n_symbols, n_lines`` (with a word), ``n_dup_lines,
    n_repeat_words`` of every row; a null text has no words, a null or missing stratum is ``none``."""
    of = F.coalesce(F.col(stratum).cast("string"), F.lit("none")) if stratum in docs.columns else F.lit("none")
    d = docs.select(F.col("doc_id"), of.alias("stratum"), F.coalesce("text", F.lit("")).alias("t"),
                    words_of(F.col("text")).alias("w"))
    d = d.select("doc_id", "stratum", "t", "w", F.expr("transform(w, x -> xxhash64(x))").alias("wh"),
                 F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("ls"))
    d = d.select(
        "doc_id", "stratum",
        F.size("w").cast("long").alias("n_words"),
        F.expr("aggregate(w, 0L, (a, x) -> a + length(x))").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("ls").cast("long").alias("n_lines"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.expr(f"""case when size(wh) < {WINDOW} then cast(array() as array<bigint>) else transform(
            sequence(1, size(wh) - {WINDOW - 1}), i -> xxhash64(slice(wh, i, {WINDOW}))) end""").alias("h"))
    same = [c for c in d.columns if c != "h"]
    # Windows sorted by hash, then place; those equal to a neighbour occur twice or more.
    d = d.select(*same, F.expr("""case when size(array_distinct(h)) = size(h)
        then cast(array() as array<struct<h: bigint, i: int>>)
        else array_sort(transform(h, (x, i) -> struct(x as h, i as i))) end""").alias("s"))
    d = d.select(*same, F.expr("""array_sort(transform(filter(s, (e, i) ->
        coalesce(e.h = get(s, i - 1).h, false) or coalesce(e.h = get(s, i + 1).h, false)), e -> e.i))""").alias("p"))
    return d.select(*same, F.expr(f"""aggregate(transform(p, (x, i) ->
        least({WINDOW}, coalesce(get(p, i + 1) - x, {WINDOW}))), 0L, (a, x) -> a + x)""").alias("n_repeat_words"))


def log_gamma(x: str) -> str:
    """SQL for ln Gamma(x), x >= 1: Stirling's series at x + 8, brought back by the recurrence."""
    z = f"({x} + 8.0D)"
    back = " * ".join(f"({x} + {k}.0D)" for k in range(8))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + {0.5 * math.log(2 * math.pi)!r}D + 1.0D / (12 * {z}) "
            f"- 1.0D / (360 * pow({z}, 3)) + 1.0D / (1260 * pow({z}, 5)) - 1.0D / (1680 * pow({z}, 7)) - ln({back}))")


def binomial_tail(n: str, k: str, p: float) -> Column:
    """P(Bin(n, p) <= k) below the mean, where terms fall off from k down; 1 at the mean or above it."""
    log_term = (f"{log_gamma(f'({n} + 1.0D)')} - {log_gamma(f'({k} + 1.0D)')} - {log_gamma(f'({n} - {k} + 1.0D)')} "
                f"+ {k} * {math.log(p)!r}D + ({n} - {k}) * {math.log1p(-p)!r}D")
    odds = (1 - p) / p
    return F.expr(f"""case when {k} >= {n} * {p!r}D then 1.0D else exp({log_term}) * aggregate(sequence(0L, {k}),
        named_struct('t', 1.0D, 's', 0.0D), (a, i) -> named_struct(
            't', a.t * ({k} - i) / ({n} - {k} + i + 1) * {odds!r}D, 's', a.s + a.t), a -> a.s) end""")


def certified_cutoffs(measured: DataFrame, labels: DataFrame, rules: dict = RULES, alpha: float = ALPHA,
                      delta: float = DELTA) -> DataFrame:
    """Chosen cutoffs ``stratum, rule, cutoff`` with ``n`` good documents, ``k`` of them rejected,
    ``r`` bad ones rejected and ``tail``.  A document with several labels counts as good if one says so;
    null ids and labels are ignored; without labels no cutoff is certified."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality_"))
    held = measured.where("n_words > 0").join(truth, "doc_id")
    tests = [(name, value, float(c)) for name, (value, cuts) in sorted(rules.items()) for c in cuts]
    good, bad = F.col("quality_") == 1, F.col("quality_") == 0
    counts = held.groupBy("stratum").agg(
        F.sum(F.when(good, 1).otherwise(0)).alias("n"),
        *[F.sum(F.when(who & (F.expr(value) > cut), 1).otherwise(0)).alias(f"{what}{i}")
          for i, (_, value, cut) in enumerate(tests) for what, who in (("k", good), ("r", bad))])
    counts = written(counts, "rule-counts")  # one row for each stratum
    each = counts.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(cut).alias("cutoff"), F.col(f"k{i}").alias("k"),
                 F.col(f"r{i}").alias("r")) for i, (name, _, cut) in enumerate(tests)])).alias("x")).select(
        "stratum", "n", "x.*")
    hypotheses = counts.count() * len(tests)
    ok = each.withColumn("tail", binomial_tail("n", "k", alpha / len(rules))).where(
        (F.col("n") > 0) & (F.col("r") > 0) & (F.col("tail") <= delta / max(1, hypotheses)))
    pick = F.max(F.struct("r", "cutoff", "n", "k", "tail")).alias("b")
    return ok.groupBy("stratum", "rule").agg(pick).select(
        "stratum", "rule", "b.cutoff", "b.n", "b.k", "b.r", "b.tail")


def quality_verdicts(docs: DataFrame, labels: DataFrame, rules: dict = RULES, alpha: float = ALPHA,
                     delta: float = DELTA, stratum: str = "lang") -> DataFrame:
    """Signals of every row with ``base_failed`` (too few words, or too many repeated ones) and ``kept``
    (neither ``base_failed`` nor above a certified cutoff of its stratum).

    A row without words fails the base rule.  Rows that repeat an id are judged one by one; other
    columns are ignored; an empty table gives no row.
    """
    ready(docs.sparkSession)
    measured = written(signals(docs, stratum), "quality-signals")
    chosen = certified_cutoffs(measured, labels, rules, alpha, delta)
    wide = chosen.groupBy("stratum").agg(*[
        F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"cut_{name}") for name in sorted(rules)])
    above = F.lit(False)
    for name, (value, _) in sorted(rules.items()):
        above = above | F.coalesce(F.expr(f"if(n_words > 0, {value}, null)") > F.col(f"cut_{name}"), F.lit(False))
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 30 * n_words")
    wide = written(wide, "rule-cutoffs")  # one row for each stratum
    if wide.count() <= BROADCAST_STRATA:
        wide = F.broadcast(wide)
    return measured.join(wide, "stratum", "left").select(
        *measured.columns, failed.alias("base_failed"), (~failed & ~above).alias("kept"))
