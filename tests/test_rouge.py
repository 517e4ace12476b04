"""ROUGE: identity, bounds, and LCS against a plain DP on a small fixture."""

import random
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from lexiscope.functions import stems

from lexiscope.operators import rouge as rg


def dp_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t[-1][-1]


def test_lcs_matches_dp():
    rnd = random.Random(7)
    for _ in range(200):
        a = [rnd.choice("abcde") for _ in range(rnd.randint(0, 25))]
        b = [rnd.choice("abcde") for _ in range(rnd.randint(0, 25))]
        assert rg.lcs_length(a, b) == dp_lcs(a, b)


def tokens(text):
    return re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()


def brute_rouge_n(pred, ref, n):
    from collections import Counter
    tp, tr = tokens(pred), tokens(ref)
    gp = Counter(tuple(tp[i:i + n]) for i in range(len(tp) - n + 1))
    gr = Counter(tuple(tr[i:i + n]) for i in range(len(tr) - n + 1))
    o = sum(min(c, gp[g]) for g, c in gr.items())
    p, r = o / max(sum(gp.values()), 1), o / max(sum(gr.values()), 1)
    return 2 * p * r / (p + r) if p + r else 0.0


def test_rouge_n_matches_brute_force(spark):
    pairs = [("a quiet river runs past the old mill", "a quiet river runs past the old mill"),
             ("a b a b c", "b a b a"), ("", "x y"), ("Zoo, ZOO! zoo.", "zoo zoo"),
             ("spark joins shuffle rows", "spark shuffles joined rows")]
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)], "k int, p string, r string")
    got = {x.k: x for x in rg.rouge_n(df, ["k"], "p", "r").collect()}
    for i, (p, r) in enumerate(pairs):
        assert abs(got[i].rouge1_f - brute_rouge_n(p, r, 1)) < 1e-12
        assert abs(got[i].rouge2_f - brute_rouge_n(p, r, 2)) < 1e-12
    assert got[0].rouge1_f == 1.0 and got[0].rouge2_f == 1.0
    by_letter = rg.rouge_n(df, ["k"], "p", "r", orders=(1,), tokenise=lambda c: F.split(F.lower(c), ""))
    assert by_letter.where("k = 0").first().rouge1_f == 1.0


def test_summary_length_limit(spark):
    df = spark.createDataFrame([("w " * 300, "w " * 130), ("w " * 300, "w " * 120)], "a string, s string")
    assert rg.summary_checks(df, "a", "s").first().n_too_long == 0
    assert rg.summary_checks(df, "a", "s", max_tokens=128).first().n_too_long == 1


def test_rouge_l_identity_and_bounds(spark):
    pairs = [("a quiet river runs past the old mill\nsecond line", "a quiet river runs past the old mill\nsecond line"),
             ("a b c", "c b a"), (None, "x")]
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)], "k int, p string, r string")
    got = {x.k: x for x in rg.rouge_l(df, ["k"], "p", "r").collect()}
    assert got[0].rougeL_f == 1.0 and got[0].rougeLsum_f == 1.0
    for x in got.values():
        assert 0.0 <= x.rougeL_f <= 1.0 and 0.0 <= x.rougeLsum_f <= 1.0
    assert got[2].rougeL_f == 0.0


def test_summary_checks_and_stability(spark):
    df = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven", "a b"),
                                (2, "x", "x y"), (3, "x", "")], "k int, article string, summary string")
    c = rg.summary_checks(df, "article", "summary").first()
    assert (c.n, c.n_empty, c.n_too_short, c.n_not_compressed) == (3, 1, 3, 1)
    s = rg.stability(df, df, ["k"], "summary").first()
    assert s.n == 3 and s.n_changed == 0


def textbook_rouge_l(pred, ref):
    """Classic-DP statement of ROUGE-L and ROUGE-Lsum (F-measures), unstemmed."""
    import re as _re
    from collections import Counter

    def tok(s):
        return _re.sub(r"[^a-z0-9]+", " ", (s or "").lower()).split()

    def table(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
        return t

    def f(p, r):
        return 2 * p * r / (p + r) if p + r else 0.0

    tp, tr = tok(pred), tok(ref)
    lcs = table(tr, tp)[-1][-1] if tp and tr else 0
    rl = f(lcs / len(tp), lcs / len(tr)) if tp and tr else 0.0
    rs = [tok(x) for x in (ref or "").split("\n")]
    cs = [tok(x) for x in (pred or "").split("\n")]
    m, n = sum(map(len, rs)), sum(map(len, cs))
    if not m or not n:
        return rl, 0.0
    cr, cc = Counter(t for s in rs for t in s), Counter(t for s in cs for t in s)
    hits = 0
    for r in rs:
        union = set()
        for c in cs:
            if not r or not c:
                continue
            t = table(r, c)
            i, j = len(r), len(c)
            while i > 0 and j > 0:
                if r[i - 1] == c[j - 1]:
                    union.add(i - 1)
                    i, j = i - 1, j - 1
                elif t[i][j - 1] > t[i - 1][j]:
                    j -= 1
                else:
                    i -= 1
        for k in sorted(union):
            w = r[k]
            if cc[w] > 0 and cr[w] > 0:
                hits += 1
                cc[w] -= 1
                cr[w] -= 1
    return rl, f(hits / n, hits / m)


def test_rouge_l_query_against_textbook(spark, sf):
    from lexiscope import fixtures
    from lexiscope.plans.queries import QUERIES
    got = {(r.conv_id, r.turn): r for r in QUERIES["rouge_l_pairs"](spark, sf).collect()}
    pairs = fixtures.conversation_pairs(spark, sf).collect()
    assert len(got) == len(pairs) > 0
    for p in pairs:
        rl, rls = textbook_rouge_l(p.summary, p.article)
        g = got[(p.conv_id, p.turn)]
        assert abs(g.rougeL_f - rl) < 1e-12 and abs(g.rougeLsum_f - rls) < 1e-12


def walk_back(ref, cand):
    """Positions by the whole table and the public scorer's ties."""
    t = [[0] * (len(cand) + 1) for _ in range(len(ref) + 1)]
    for i in range(1, len(ref) + 1):
        for j in range(1, len(cand) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if ref[i - 1] == cand[j - 1] else max(t[i - 1][j], t[i][j - 1])
    out, i, j = [], len(ref), len(cand)
    while i and j:
        if ref[i - 1] == cand[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def test_bit_vectors_take_the_same_positions():
    rnd = random.Random(3)
    for _ in range(400):
        a = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 90))]
        b = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 90))]
        assert rg.BitLcs(a, b).positions() == walk_back(a, b)


def test_two_long_lines_stay_small(spark):
    rnd = random.Random(1)
    a, b = ([f"w{int(rnd.paretovariate(0.6)) % 5000}" for _ in range(20_000)] for _ in range(2))
    tracemalloc.start()
    found = rg.BitLcs(a, b)
    n, at = found.length(), found.positions()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(at) == n and at == sorted(at, reverse=True) and peak < 100e6
    inside = iter(b)
    assert all(a[i] in inside for i in reversed(at))  # a common subsequence
    df = spark.createDataFrame([(1, " ".join(a), " ".join(b))], "k int, p string, r string")
    row = rg.rouge_l(df, ["k"], "p", "r").first()
    assert row.rougeL_f == row.rougeLsum_f == 2 * (n / 20_000) ** 2 / (2 * (n / 20_000))


# Published pairs of a word and its stem.
STEMS = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss
fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc
hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness
callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal
electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner
airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll generalizations gener
oscillators oscil""".split()


def test_published_stems(spark):
    want = dict(zip(STEMS[::2], STEMS[1::2]))
    got = stems.porter(spark.createDataFrame([(w,) for w in want], "word string")).collect()
    assert {r.word: r.stem for r in got} == want


def test_short_and_odd_words(spark):
    words = ["", "a", "is", "was", "eed", "ing", "sses", "ssss", "2020s", "x9ing", "yyying", "aeiou", "s" * 500 + "ing", None]
    got = {r.word: r.stem for r in stems.porter(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got[""] == "" and got["was"] == "was" and got["2020s"] == "2020" and got[None] is None and got["sses"] == "ss"
    assert len(got) == len(words)


def stemmed_pairs(spark):
    return spark.createDataFrame([
        (1, "The ponies were hopping,\nagreed!", "A pony hops; agreeing happily\n\nRelational operators."),
        (2, None, "!!!"), (3, "", "only ties"), (4, "happy happy happy", "happiness, HAPPY")], "k int, p string, r string")


def test_stems_replace_words_line_by_line(spark):
    pairs = stemmed_pairs(spark)
    got = {r.k: (r.p, r.r) for r in rg.stemmed(pairs, ["k"], ["p", "r"]).collect()}
    assert got == {1: ("the poni were hop\nagre", "a poni hop agre happili\n\nrelat oper"), 2: ("", ""), 3: ("", "onli ti"),
                   4: ("happi happi happi", "happi happi")}
    dealt = {r.k: (r.p, r.r) for r in rg.stemmed(pairs, ["k"], ["p", "r"], max_broadcast=0).collect()}
    assert dealt == got  # the salted join gives the same texts
    assert rg.stemmed(pairs.where("false"), ["k"], ["p", "r"]).count() == 0


def test_perfect_match_scores_one_on_stems(spark):
    df = spark.createDataFrame([(1, "hopping ponies\nagree", "hopping ponies\nagree")], "k int, p string, r string")
    texts = rg.stemmed(df, ["k"], ["p", "r"])
    assert rg.rouge_n(texts, ["k"], "p", "r").first().rouge2_f == 1.0 == rg.rouge_l(texts, ["k"], "p", "r").first().rougeLsum_f


def test_bootstrap_brackets_the_mean(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.random(), 0.25) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, a_f double, b_f double")
    got = {r.metric: r for r in rg.bootstrap(df, ["k"], ["a_f", "b_f"]).collect()}
    mean = sum(r[1] for r in rows) / len(rows)
    sd = (sum((r[1] - mean) ** 2 for r in rows) / len(rows)) ** 0.5 / len(rows) ** 0.5
    assert abs(got["a"].mid - mean) < sd / 2
    for mark, z in (("low", -1.96), ("high", 1.96)):
        assert abs(got["a"][mark] - (mean + z * sd)) < 0.35 * sd
    assert (got["b"].low, got["b"].mid, got["b"].high) == (0.25, 0.25, 0.25)
    again = {r.metric: r for r in rg.bootstrap(df.repartition(7), ["k"], ["a_f", "b_f"]).collect()}
    assert again == got
    assert rg.bootstrap(df.where("false"), ["k"], ["a_f"]).count() == 0


def test_poisson_weights_have_mean_one():
    steps = rg.poisson_steps()
    assert sum(65536 - t for t in steps) / 65536 == pytest.approx(1, abs=2e-4)


def test_rouge_n_tasks_follow_the_volume(spark, monkeypatch):
    """A task counts the n-grams of so many bytes of text, however many partitions a shuffle has."""
    import re
    monkeypatch.setattr(rg, "TASK_BYTES", 1000, raising=False)
    rows = [(i, f"the cat {i} sat " * 20, f"a cat {i} sat " * 20) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, p string, r string")
    size = sum(len(p) + len(r) for _, p, r in rows)
    out = rg.rouge_n(df, ["k"], "p", "r")
    dealt = re.search(r"hashpartitioning\(k#\d+, (\d+)\)", out._jdf.queryExecution().executedPlan().toString())
    assert int(dealt.group(1)) >= size // 1000
    assert out.count() == 100 and abs(out.where("k = 7").first().rouge1_f - 0.75) < 1e-12
    empty = rg.rouge_n(df.where("k < 0"), ["k"], "p", "r")
    assert empty.count() == 0
