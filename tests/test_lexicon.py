"""Tagger, vote and bias: traps of SURVEY 1.1 and a brute-force check."""

import itertools

import pytest

from lexiscope import fixtures
from lexiscope.functions import text as tx
from lexiscope.operators import lexicon as lx


def dictionary(spark, rows):
    cols = ["word"] + list(lx.CATEGORIES)
    return spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c == 'word' else 'int'}" for c in cols))


def signals(spark, texts, rows, mode="before_lookup", litigious="negative"):
    lk = lx.prepare_lookup(dictionary(spark, rows), stopword_mode=mode)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in lx.lexicon_signals(docs, lk, litigious=litigious).collect()}


def row(word, **cats):
    return tuple([word] + [cats.get(c, 0) for c in lx.CATEGORIES])


def test_tie_goes_to_first_seen(spark):
    rows = [row("BAD", negative=1), row("GOOD", positive=1)]
    s = signals(spark, ["bad good good bad", "good bad"], rows)
    assert s[0].lexicon_tag == "negative" and s[1].lexicon_tag == "positive"


def test_no_tags_is_neutral_and_zero_bias(spark):
    s = signals(spark, ["nothing here", "", None], [row("BAD", negative=1)])
    for r in s.values():
        assert r.lexicon_label == "neutral" and r.bias_score == 0.0 and r.bias_flag is False
    assert s[0].n_cns == 1  # "here" is a stopword


def test_sign_rule_priority_and_stopwords(spark):
    rows = [row("RE", negative=-2020), row("DUAL", positive=1, negative=1), row("THAN", negative=1)]
    s = signals(spark, ["re dual than"], rows)[0]
    assert s.n_cns == 1 and s.n_positive == 1 and s.n_negative == 0  # THAN is a stopword


def test_stopword_modes(spark):
    rows = [row("GOOD", positive=1)]
    chain = signals(spark, ["the good"], rows, mode="before_lookup")[0]
    batch = signals(spark, ["the good"], rows, mode="in_dictionary")[0]
    assert chain.n_cns == 0 and batch.n_cns == 1


def test_litigious_modes(spark):
    rows = [row("SUE", litigious=1)]
    assert signals(spark, ["sue"], rows)[0].lexicon_label == "negative"
    assert signals(spark, ["sue"], rows, litigious="drop")[0].lexicon_label is None


def test_bias_threshold_float_order(spark):
    rows = [row("UU", uncertainty=1), row("LL", litigious=1), row("CC", constraining=1), row("PP", positive=1)]
    text = " ".join(["uu"] * 2 + ["ll"] * 4 + ["cc"] * 3 + ["pp"] * 11)
    s = signals(spark, [text], rows)[0]
    assert s.bias_score == 0.15 and s.bias_flag is True  # ((0.1+0.2)+0.15)/3 > 0.15 in double


def test_duplicate_words_rejected(spark):
    with pytest.raises(ValueError):
        lx.prepare_lookup(dictionary(spark, [row("good", positive=1), row("GOOD", negative=1)]))


def test_broadcast_bound_is_checked(spark, sf):
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark), max_broadcast_rows=3)
    assert lk.broadcast is False and lk.rows > 3
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark), max_broadcast_bytes=100)
    assert lk.broadcast is False and lk.approx_bytes > 100
    # Beyond the bound the tagger falls back to a shuffle join and gives the same result.
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    small = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    a = lx.lexicon_signals(docs, small)
    b = lx.lexicon_signals(docs, lk)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


SEPARATORS = set(",:'.") | {chr(c) for c in range(0x3001) if chr(c).isspace()}


def by_character(text, tag_of):
    """Tags of the kept words, the vote (most often, then first) and the flag, found character by character."""
    runs = ("".join(g) for sep, g in itertools.groupby(text or "", SEPARATORS.__contains__) if not sep)
    tags = [tag_of.get(r.upper(), "cns") for r in runs if len(r) > 1 and r.upper() not in tx.STOPWORDS]
    voted = [t for t in tags if t != "cns"]
    ranked = sorted(set(voted), key=lambda t: (-voted.count(t), voted.index(t)))
    u, l, c = (voted.count(x) / len(voted) if voted else 0.0 for x in lx.BIAS_CATEGORIES)
    return tags, ranked[0] if ranked else None, (u + l + c) / 3 > 0.15


def test_against_brute_force(spark, sf):
    tag_of = {}
    for cat in reversed(lx.CATEGORIES):  # an earlier category overrides
        tag_of |= dict.fromkeys(fixtures.FIXTURE_CATEGORY_WORDS[cat], cat)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    got = {r.doc_id: r for r in lx.lexicon_signals(docs, lk).collect()}
    lists = {r.doc_id: r.sentiment_list for r in lx.tag_lists(docs, lk).collect()}
    for d in docs.collect():
        tags, top, flag = by_character(d.text, tag_of)
        assert lists[d.doc_id] == tags
        assert got[d.doc_id].lexicon_tag == top
        assert got[d.doc_id].bias_flag == flag


def test_profile(spark):
    p = lx.dictionary_profile(fixtures.fixture_dictionary(spark)).first()
    assert p.n_negative == 7 and p.n_complexity == 1 and p.n_stopwords == 1


@pytest.mark.parametrize("mode,litigious", [("before_lookup", "negative"), ("in_dictionary", "drop")])
def test_tagging_shapes_agree(spark, sf, mode, litigious):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark), stopword_mode=mode)
    a = lx.lexicon_signals(docs, lk, litigious=litigious)
    b = lx.lexicon_signals_rowwise(docs, lk, litigious=litigious)
    cols = [c for c in a.columns]
    assert a.count() == b.count() == docs.count()
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0


@pytest.mark.parametrize("mode", lx.STOPWORD_MODES)
def test_shuffled_lookup_agrees(spark, sf, mode):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, ", the . LOSS a"), (-4, "x : loss")], "doc_id long, text string"))
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark), stopword_mode=mode)
    shuffled = lx.prepare_lookup(fixtures.fixture_dictionary(spark), stopword_mode=mode, max_broadcast_rows=3)
    for fn in (lx.lexicon_signals, lx.token_tags):
        a, b = fn(docs, lk), fn(docs, shuffled)
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert lx.lexicon_signals(docs, shuffled).count() == docs.count()


def test_dictionary_log_format(spark):
    counts = {"negative": 2355, "positive": 354, "uncertainty": 297, "litigious": 905,
              "strong_modal": 19, "weak_modal": 27, "constraining": 184, "complexity": 53}
    row = {"n_words": 86553, **{f"n_{k}": v for k, v in counts.items()}}
    prof = spark.createDataFrame([row])
    got = [r.line for r in lx.dictionary_log_lines(prof).orderBy("line_no").collect()]
    expected = [f"    {86553:,} words loaded in master_dictionary.", "    Sentiment:"]
    expected += [f"      {k:13}: {counts[k]:8,}" for k in lx.LOG_CATEGORIES]
    assert got == expected
