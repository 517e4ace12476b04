"""Random texts: what must hold for every cleaned text, and character-level counts of tokens and tags."""

import itertools
import random
import unicodedata

from pyspark.sql import functions as F

from lexiscope.functions import text as tx

ALPHABET = (list("abcXYZ019 ?'.,:;-<>&/\"!") + ["’", "é", "ß", "½", "ﬁ", "Œ", "İ", "ﬀ", "€", "㎏", "①",
            "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "　",
            " ", "𝐀", "ǅ", "ﾊ"])
PIECES = ["<b>", "</p>", "&amp;", "&AMP;", "&#39;", "won't", "CAN'T", "isn't", "'re", "'s", "'d",
          "'ll", "'ve", "'m", "n't", "<5 and y>", "  ", "??"]


def random_texts(n=400, seed=11):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 12)):
            parts.append(rnd.choice(PIECES) if rnd.random() < 0.3
                         else "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 6))))
        out.append("".join(parts))
    return out


SEPARATORS = set(",:'.") | {chr(c) for c in range(0x3001) if chr(c).isspace()}


def tokens(t):
    """Runs of characters that are no separators, of two or more."""
    runs = ("".join(g) for sep, g in itertools.groupby(t, SEPARATORS.__contains__) if not sep)
    return [r for r in runs if len(r) > 1]


def test_light_clean_tokens_and_strip_by_character(spark):
    texts = random_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", tx.light_clean(F.col("t")).alias("l"), tx.tokenize(F.col("t")).alias("k"),
                     tx.py_strip(F.col("t")).alias("s")).collect()
    for r in rows:
        t = texts[r.i]
        assert r.l == "".join({10: " ", 13: " "}.get(ord(ch), ch) for ch in t if ch != "?").strip(), t
        assert r.k == tokens(t), t
        assert r.s == t.strip(), t


def test_every_cleaned_text_has_the_cleaned_form(spark):
    texts = random_texts()
    folded = ["".join(ch for ch in unicodedata.normalize("NFKD", t) if ord(ch) < 128) for t in texts]
    df = spark.createDataFrame([(i, t, f) for i, (t, f) in enumerate(zip(texts, folded))],
                               "i int, t string, f string")
    c = tx.clean_text
    rows = df.select("t", "f", tx.ascii_fold(F.col("t")).alias("fold"), c(F.col("t")).alias("c"),
                     c(F.col("f")).alias("of_fold"), c(F.concat(F.lit("\n <i>"), "t", F.lit(" &x; \t"))).alias("padded"),
                     c(F.concat(F.lit("Ab "), "t", F.lit(" Yz"))).alias("between")).collect()
    for r in rows:
        assert r.fold == r.f and r.of_fold == r.c
        assert r.c.isascii() and not any(ch.isupper() or ch == "?" for ch in r.c)
        assert not any(ch.isspace() and ch != " " for ch in r.c) and r.c == r.c.strip(" ")
        assert r.between.startswith("ab") and r.between.endswith("yz")
        if not set(r.t) & set("<>&;'?"):  # nothing for the other steps: the words alone are left
            assert r.c.split() == r.f.lower().split() and r.padded == r.c


def test_tagging_matches_python_on_random_texts(spark):
    from lexiscope.operators import lexicon as lx
    words = {"GOOD": "positive", "BAD": "negative", "MAYBE": "uncertainty", "SUE": "litigious",
             "MUST": "strong_modal", "MIGHT": "weak_modal", "LIMIT": "constraining",
             "STRASSE": "negative", "FINE": "positive", "THE": "positive"}
    cats = list(lx.CATEGORIES)
    rows = [tuple([w] + [1 if c == tag else 0 for c in cats]) for w, tag in words.items()]
    dic = spark.createDataFrame(rows, "word string, " + ", ".join(f"{c} int" for c in cats))
    rnd = random.Random(5)
    vocab = ["good", "Bad", "maybe", "sue", "must", "might", "limit", "straße", "ﬁne", "the", "x",
             "zz", "Good.", "bad,", "it", "THAN", "qq'ww"]
    seps = [" ", ".", ",", ":", "'", "\n", "\xa0", "  ", "; "]
    texts = [" ".join(rnd.choice(vocab) + rnd.choice(seps) for _ in range(rnd.randint(0, 30)))
             for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for mode in lx.STOPWORD_MODES:
        lk = lx.prepare_lookup(dic, stopword_mode=mode)
        got = {r.doc_id: r for r in lx.lexicon_signals(docs, lk).collect()}
        for i, t in enumerate(texts):
            upper = [u for u in map(str.upper, tokens(t))
                     if u not in tx.STOPWORDS or (mode == "in_dictionary" and u not in words)]
            seen = [words[u] for u in upper if u in words]
            ranked = sorted(set(seen), key=lambda g: (-seen.count(g), seen.index(g)))
            assert got[i].lexicon_tag == (ranked[0] if ranked else None), (mode, t)
            assert got[i].n_cns == len(upper) - len(seen), (mode, t)
