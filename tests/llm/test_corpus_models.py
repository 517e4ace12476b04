"""Language model, language identification, quality rules and toxicity."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import zlib
from pyspark.sql import functions as F

from lexiscope.llm import katz_lm, language_id, quality_rules, queries, toxicity
from lexiscope.llm.common import crc_mod

WHITE = " \t\n\x0b\f\r"


def crc(i, m):
    return None if i is None else zlib.crc32(str(i).encode()) % m


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE[1:]:
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [None]  # None: the end


def factors(n, k=katz_lm.K):
    d = [1.0] * (k + 1)
    if n[1] and n[k + 1] and (common := (k + 1) * n[k + 1] / n[1]) < 1:
        for r in range(1, k + 1):
            if n[r] and 0 < (x := ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)) <= 1:
                d[r] = x
    return lambda c: c * (d[c] if c <= k else 1.0)


class PlainKatz:
    """The model by its definition, over dictionaries."""

    def __init__(self, texts):
        self.c1, self.c2, self.h = Counter(), Counter(), Counter()
        for t in texts:
            prev = "<s>"
            for w in tokens(t):
                self.c1[w] += 1
                self.c2[prev, w] += 1
                self.h[prev] += 1
                prev = w
        self.n = sum(self.c1.values())
        f1, self.f2 = factors(Counter(self.c1.values())), factors(Counter(self.c2.values()))
        mass = sum(map(f1, self.c1.values())) / self.n
        s = self.n / (self.n + 1) if mass >= 1 - 1e-12 else 1.0
        self.p1 = {w: f1(c) / self.n * s for w, c in self.c1.items()}
        self.unknown = 1 - mass * s
        seen = defaultdict(list)
        for (a, b), c in self.c2.items():
            seen[a].append((b, c))
        self.p2, self.alpha = {}, {}
        for a, of in seen.items():
            m = sum(self.f2(c) for _, c in of) / self.h[a]
            s = self.h[a] / (self.h[a] + 1) if m >= 1 - 1e-12 else 1.0
            for b, c in of:
                self.p2[a, b] = self.f2(c) / self.h[a] * s
            self.alpha[a] = (1 - m * s) / (1 - sum(self.p1[b] for b, _ in of))

    def p(self, a, b):
        return self.p2[a, b] if (a, b) in self.p2 else self.alpha.get(a, 1.0) * self.p1.get(b, self.unknown)

    def score(self, text):
        total, prev = 0.0, "<s>"
        for w in tokens(text):
            total += math.log10(self.p(prev, w))
            prev = w
        return total


@pytest.fixture(scope="module")
def lm_docs(odd_texts):
    return [(i, t if t is None or len(t) < 100_000 else t[:60_000]) for i, t in odd_texts]


#: Everything broadcast; words and pairs of some weight broadcast; nothing broadcast; many buckets.
SETTINGS = [{"hot_word": 1e-9, "hot_pair": 1e-9}, {"hot_word": 2e-3, "hot_pair": 1e-3},
            {"hot_word": 1.0, "hot_pair": 1.0, "bucket_tokens": 500}, {"hot_word": 2e-4, "hot_pair": 1.0, "bucket_tokens": 900}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_scores_follow_the_definition(make_docs, lm_docs, settings):
    train = [t for i, t in lm_docs if i is not None and crc(i, 7) != 2]
    model = PlainKatz(train)
    v = len(model.c1)
    want = defaultdict(list)
    for i, t in lm_docs:
        ws = tokens(t)
        base = sum(math.log10((model.c1[w] + 1) / (model.n + v + 1)) for w in ws)
        want[i].append((i is not None and crc(i, 7) == 2, len(ws), sum(model.c1[w] > 0 for w in ws), base, model.score(t)))
    got = defaultdict(list)
    out = katz_lm.score_documents(make_docs(lm_docs).drop("held_out", "train"), crc_mod("doc_id", 7) == 2, **settings)
    for r in out.collect():
        assert r["train_tokens"] == model.n
        got[r["doc_id"]].append((r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]))
    assert set(got) == set(want)
    for i in want:
        for a, b in zip(sorted(want[i]), sorted(got[i]), strict=True):
            assert a[:3] == b[:3]
            assert b[3:] == pytest.approx(a[3:], rel=1e-9, abs=1e-7)


def test_every_history_sums_to_one(lm_docs):
    model = PlainKatz([t for _, t in lm_docs[:40]])
    for a in list(model.alpha)[:50]:
        total = sum(model.p(a, b) for b in model.c1) + model.alpha[a] * model.unknown
        assert total == pytest.approx(1, abs=1e-9)


def test_language_model_without_documents_or_training(make_docs, no_docs):
    assert katz_lm.score_documents(no_docs, F.lit(False)).count() == 0
    rows = katz_lm.score_documents(make_docs([(1, "a b"), (2, None)]).drop("held_out", "train"), F.lit(True)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["score"]) for r in rows} == {(1, 3, 0, 0.0), (2, 1, 0, 0.0)}


def test_language_held_out_accuracy(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang")
    got = queries.op5_language_id(spark, big).where("held_out").join(docs, "doc_id").collect()
    assert len(got) > 150 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)


def test_language_of_odd_rows(make_docs, no_docs, odd_texts):
    model = language_id.fit(make_docs(odd_texts))
    source = make_docs(odd_texts)
    got = language_id.predict(source, model)
    assert got.columns == [c for c in source.columns if c not in ("score", "lang_pred")] + ["lang_pred", "score"]
    rows = {(r["doc_id"], r["text"]): r for r in got.collect()}
    assert len(rows) == len(set(odd_texts))
    for (i, t), r in rows.items():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= r["score"] <= 1
    assert language_id.predict(no_docs, model).count() == 0
    nothing = language_id.predict(source, language_id.fit(no_docs)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert language_id.keep_known(source, model).columns == source.columns


def test_pair_machine_separates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0, "a", "b").astype(object)
    vote = language_id.PairVote(x, y)
    best, sure = vote.predict(x)
    assert (np.array([vote.classes[b] for b in best]) == y).mean() > 0.97 and (sure >= 0.5).all()


def base_signals(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_signals(make_docs, odd_texts, no_docs, spark):
    docs = odd_texts + [(4000, "a b c d e f g h a b c d e f g h"), (4001, "a " * 40), (4002, "x\nx\n x\nx\n\n\n"),
                        (4003, "### $$ <|> é&"), (4004, " ".join("abcdefgh") + " z " + " ".join("abcdefgh"))]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = quality_rules.quality_verdicts(make_docs(docs).drop("stratum"), labels).collect()
    want = Counter((i, *base_signals(t)) for i, t in docs)
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in out) == want
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])  # nothing is certified by these labels
    assert quality_rules.quality_verdicts(no_docs, labels).count() == 0


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.3), (100, 2, 0.05), (1000, 3, 0.004), (20000, 50, 0.004), (5, 5, 0.1), (1, 0, 0.9)])
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(quality_rules.binomial_tail(f"{n}L", f"{k}L", p).alias("x")).first()["x"]
    exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
                for i in range(k + 1))
    assert got == pytest.approx(exact if k < n * p else 1.0, rel=1e-9)


def test_cutoffs_are_certified(spark):
    rows = [(i, "en", 100 if i % 2 else 1, i % 2) for i in range(8000)]
    measured = spark.createDataFrame([(i, lang, 100, 500, s if q == 0 else 1, 10, 0, 0) for i, lang, s, q in
                                      [(i, lang, 100 - s, q) for i, lang, s, q in rows]],
                                     "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    labels = spark.createDataFrame([(i, q, 0) for i, _, _, q in rows], "doc_id long, quality int, toxic int")
    got = quality_rules.certified_cutoffs(measured, labels).collect()
    assert [(r["rule"], r["cutoff"]) for r in got] == [("symbols", 0.75)]  # bad ones have 0.99 a word, good ones 0.01
    tests = sum(len(c) for _, c in quality_rules.RULES.values())
    assert got[0]["tail"] <= quality_rules.DELTA / tests and got[0]["k"] == 0 and got[0]["r"] == 4000


def brute_marginals(chain, e):
    """All state sequences of a short line."""
    n = len(e)
    total, hot = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [(bits >> i) & 1 for i in range(n)]
        s = sum(e[i] for i in range(n) if y[i]) + (chain.start if y[0] else 0)
        s += sum(chain.trans[y[i - 1], y[i]] for i in range(1, n))
        total += math.exp(s)
        hot += math.exp(s) * np.array(y)
    return hot / total


def test_marginals_match_all_sequences():
    rng = np.random.default_rng(4)
    chain = toxicity.Chain()
    chain.trans, chain.start = rng.normal(size=(2, 2)), 0.7
    lines = [rng.normal(size=n) for n in (3, 0, 1, 7, 5, 7, 2)]
    for e, p in zip(lines, chain.marginals(lines)):
        assert p == pytest.approx(brute_marginals(chain, e) if len(e) else [], abs=1e-9)


def test_training_raises_likelihood():
    chain = toxicity.Chain()
    lines = [([toxicity.word_features(w) for w in "a bad b c".split()], [0, 1, 0, 0]),
             ([toxicity.word_features(w) for w in "a b c d".split()], [0, 0, 0, 0])] * 50
    chain.fit(lines)
    p = chain.marginals([chain.emissions("a bad b c".split(), {}), chain.emissions("c badly a".split(), {})])
    assert p[0][1] > 0.9 and p[0][[0, 2, 3]].max() < 0.2
    assert p[1].argmax() == 1  # a word that shares letters with the toxic one


def test_toxicity_held_out(spark, sf):
    big = sf.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic")
    got = queries.op10_toxicity(spark, big).where("held_out").join(labels, "doc_id").collect()
    hit = Counter((r["toxic"], r["predicted"]) for r in got)
    assert hit[(1, 1)] >= 0.8 * (hit[(1, 1)] + hit[(1, 0)]) and hit[(0, 1)] <= 0.03 * (hit[(0, 1)] + hit[(0, 0)])
    for r in got[:200]:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_toxicity_of_odd_rows(spark, make_docs, no_docs, odd_texts):
    words = ["calm", "river", "stone", "tree", "bird"]
    training = [(i, " ".join(words[(i + k) % 5] + str((i * 7 + k) % 11) for k in range(12)) + (" vilewretch" if i % 4 == 0 else ""), int(i % 4 == 0))
                for i in range(400)]
    chain = toxicity.fit(spark.createDataFrame([*training, (None, "x", 1), (9, None, 1), (8, "y", None)], "doc_id long, text string, toxic int"))
    docs = odd_texts + [(8000, "calm1 VILEWRETCH, river2\n\n  two vilewretch"), (8001, "calm1 river2")]
    source = make_docs(docs)
    got = toxicity.score_documents(source, chain).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in docs)
    by = {r["doc_id"]: r for r in got}
    assert by[8000]["predicted"] == 1 and by[8001]["predicted"] == 0 and by[1002]["predicted"] == 0
    text = dict(docs)[8000]
    assert [text[s["start"]:s["end"]].strip(",").lower() for s in by[8000]["spans"]] == ["vilewretch"] * 2
    assert toxicity.score_documents(no_docs, chain).count() == 0
    nothing = toxicity.score_documents(source, toxicity.fit(spark.createDataFrame([], "doc_id long, text string, toxic int")))
    assert {r["predicted"] for r in nothing.collect()} == {0}


def test_toxicity_learns_from_long_lines(spark):
    rng = np.random.default_rng(7)

    def text(i, toxic):
        words = [f"plain{x}" for x in rng.integers(0, 300, 500 + i % 700)]
        for at in rng.integers(0, len(words), 4 if toxic else 0):
            words[at] = "vilewretch"
        return " ".join(words)

    rows = [(i, text(i, i % 4 == 0), int(i % 4 == 0)) for i in range(240)]
    schema = "doc_id long, text string, toxic int"
    chain = toxicity.fit(spark.createDataFrame(rows[:160], schema))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(spark.createDataFrame(rows[160:], schema), chain).collect()}
    assert got == {i: toxic for i, _, toxic in rows[160:]}


def test_long_lines_are_cut_whole():
    words = [f"w{i}" for i in range(2 * toxicity.LINE_WORDS + 1)]
    lines = toxicity.training_lines("a b\n\n" + " ".join(words) + "\nc")
    assert [len(x) for x in lines] == [2, toxicity.LINE_WORDS, toxicity.LINE_WORDS, 1, 1]
    assert sum(lines, []) == ["a", "b", *words, "c"]


def test_training_without_lines():
    chain = toxicity.Chain()
    chain.fit([])
    assert not chain.w.any() and chain.bias == toxicity.Chain().bias
