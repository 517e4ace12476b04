"""The displacement table finds every word and no other."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.functions import word_table as wt
from lexiscope.operators import lexicon as lx
from lexiscope.operators import report as rp


def test_every_word_has_a_slot_of_its_own():
    rnd = random.Random(4)
    for n in (0, 1, 2, 7, 1000, 60_000):
        rows = [(f"w{i}", i % 9 - 1, rnd.getrandbits(64) - (1 << 63)) for i in range(n)]
        table = wt.build(rows)
        assert not table.rest and sum(w != "" for w in table.words) == n
        for word, code, h in rows:
            h &= (1 << 64) - 1
            s = wt._slot(h, table.displacement[(h >> 8 & wt.LOW31) % len(table.displacement)], len(table.words))
            assert table.words[s] == word and table.codes[s] == code


def test_words_of_one_hash_go_to_the_rest():
    table = wt.build([("a", 1, 5), ("b", 2, 5), ("c", 3, 99)])
    assert {"a", "b"} <= set(table.rest) | set(table.words) and table.rest["a"] == 1 and table.rest["b"] == 2


@pytest.mark.parametrize("n", [0, 1, 30_000])
def test_codes_of_tokens(spark, n):
    words = spark.createDataFrame([(f"WORD{i}É", i % 7 + 1) for i in range(n)], "word string, code int")
    table = wt.collect(words)
    tokens = [f"WORD{i}É" for i in (0, 1, 29_999, 30_000)] + ["", "word0é", "x" * 10_000, "\n"]
    df = spark.createDataFrame([(1, tokens), (2, []), (3, None)], "k int, t array<string>")
    got = {r.k: r.c for r in df.select("k", wt.codes_of(F.col("t"), table).alias("c")).collect()}
    assert [x.code for x in got[1]] == [i % 7 + 1 if i < n else None for i in (0, 1, 29_999, 30_000)] + [None] * 4
    assert got[2] == [] and got[3] is None


def test_rowwise_takes_a_large_dictionary(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    derived = fixtures.derived_dictionary(spark, sf)
    filler = spark.range(60_000).select(F.concat(F.lit("FILLER"), "id").alias("word"), *[
        F.lit(1 if c == "positive" else 0).alias(c) for c in derived.columns[1:]])
    lookup = lx.prepare_lookup(derived.unionByName(filler, allowMissingColumns=True))
    assert lookup.rows > 60_000
    a, b = lx.lexicon_signals(docs, lookup), lx.lexicon_signals_rowwise(docs, lookup)
    assert a.select(b.columns).exceptAll(b).count() == 0 and b.count() == a.count()


def large_lookup(spark, mode="before_lookup", n=60_000):
    """The fixture dictionary, two stopwords (one tags) and many words that no text holds."""
    words = fixtures.fixture_dictionary(spark).select("word", *lx.CATEGORIES)
    row = lambda word, on: [word.alias("word"), *[F.lit(int(c == on)).alias(c) for c in lx.CATEGORIES]]
    more = spark.range(n).select(*row(F.concat(F.lit("FILLER"), "id"), "positive"))
    stop = spark.createDataFrame([("THE",)], "w string").select(*row(F.col("w"), "negative"))
    return lx.prepare_lookup(words.unionByName(more).unionByName(stop), mode)


def test_a_large_lookup_is_no_part_of_the_plan(spark):
    """Its words are neither rows nor literals of the driver."""
    docs = spark.createDataFrame([(1, "the thing")], "doc_id long, text string")
    for make in (lx.tag_counts_rowwise, rp.report_table_rowwise):
        df = make(docs, large_lookup(spark))
        assert len(df._jdf.queryExecution().toString()) < 1 << 20
        assert "FILLER5" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("mode", lx.STOPWORD_MODES)
def test_a_large_lookup_tags_like_the_join(spark, mode):
    lookup = large_lookup(spark, mode)
    assert lookup.broadcast and lookup.rows > 60_000
    texts = ["The thing is erin's than, filler5 FILLER59999 filler60000 a b", "", None, "x", "the the of", "\u00e9\u4e2d thing\u00df tion",
             "ha " * 5000, " ,:'."]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "thing")], "doc_id long, text string").repartition(3)
    a, b = lx.lexicon_signals(docs, lookup), lx.lexicon_signals_rowwise(docs, lookup)
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count() and b.count() == len(texts) + 1


def test_packed_words_of_one_hash():
    """Words whose hashes are equal are told apart, and a token with the hash of a word is not taken for it."""
    words, codes, h = pa.array(["a", "b", "c", "d"]), np.array([1, 2, 3, 4], "int8"), np.array([-7, 5, 5, 9])
    assert wt.most_of_one_hash(h) == 2 and wt.most_of_one_hash(h[:0]) == 0
    tokens, hashes = pa.array(["c", "b", "x", "d", "z", "a", "b"]), np.array([5, 5, 5, 9, 11, -7, 9])
    assert wt.find_codes(words, codes, h, 2, tokens, hashes, 0).tolist() == [3, 2, 0, 4, 0, 1, 0]
    assert wt.find_codes(words[:0], codes[:0], h[:0], 0, tokens, hashes, 0).tolist() == [0] * 7


def test_beyond_the_broadcast_bound_it_joins(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    small = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    large = lx.prepare_lookup(fixtures.fixture_dictionary(spark), max_broadcast_rows=1)
    assert not large.broadcast
    a, b = lx.lexicon_signals_rowwise(docs, small), lx.lexicon_signals_rowwise(docs, large)
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
