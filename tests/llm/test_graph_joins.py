"""Near duplicates and benchmark leaks against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lexiscope.llm import decontaminate, ngram_join
from lexiscope.llm.components import components

WHITE = " \t\n\x0b\f\r"


def plain_words(text):
    out, word = [], ""
    for ch in (text or "") + " ":
        if ch in WHITE:
            if word:
                out.append(word)
            word = ""
        else:
            word += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    return out


def shingle_set(text):
    w = plain_words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_texts():
    rng = np.random.default_rng(5)
    base = [f"v{x}" for x in rng.integers(0, 400, 120)]
    out = []
    for k in range(40):  # a group of near copies with one to three changed words each
        w = list(base)
        for p in rng.integers(0, 120, k % 4):
            w[p] = f"c{k}p{p}"
        out.append((5000 + k, " ".join(w)))
    out += [(5100, "only four words here"), (5101, "only four words here"), (5102, "Only  FOUR words\nhere")]
    out += [(5200 + k, " ".join(f"u{k}x{i}" for i in range(30))) for k in range(5)]
    return out


@pytest.fixture(scope="module")
def joined(make_docs, odd_texts):
    docs = odd_texts + near_texts()
    return docs, ngram_join.near_duplicates(make_docs(docs), block=16).collect()


def test_links_and_classes_match_brute_force(joined):
    docs, got = joined
    sets = [shingle_set(t) for _, t in docs]
    n = len(docs)
    near = [[i != j and bool(sets[i]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
             for j in range(n)] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *(root[j] for j in range(n) if near[i][j])]) for i in range(n)]
        if new == root:
            break
        root = new
    least = defaultdict(list)
    for i, r in enumerate(root):
        if docs[i][0] is not None:
            least[r].append(docs[i][0])
    want = Counter()
    for i, (doc_id, text) in enumerate(docs):
        other = {docs[j][1] for j in range(n) if near[i][j]} - {text}
        copies = sum(near[i][j] and docs[j][1] == text for j in range(n)) + 1
        want[(doc_id, min(least[root[i]], default=None), copies, len(other), sum(near[i]))] += 1
    assert Counter((r["doc_id"], r["class_id"], r["n_copies"], r["n_text_links"], r["n_links"]) for r in got) == want
    assert max(r["n_text_links"] for r in got) > 20


def test_one_of_each_class_stays(joined, make_docs, odd_texts, no_docs):
    docs, got = joined
    source = make_docs(docs)
    kept = ngram_join.drop_near_duplicates(source, block=16)
    assert kept.columns == source.columns
    rows = Counter((r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect())
    grouped = {(r["doc_id"], r["class_id"]) for r in got if r["n_copies"] > 1 or r["n_links"] > 0}
    alone = [(r["doc_id"]) for r in got if not (r["n_copies"] > 1 or r["n_links"] > 0)]
    assert sum(rows.values()) == len(alone) + len({c for _, c in grouped})
    assert rows[(5000, dict(near_texts())[5000])] == 1 and (5001, dict(near_texts())[5001]) not in rows
    assert ngram_join.near_duplicates(no_docs).count() == 0
    assert ngram_join.drop_near_duplicates(no_docs).count() == 0


def test_prefix_depth():
    assert ngram_join.prefix_depth(0.8, 16, 8, 0.999) == 4
    for d in (4, 5):
        reach = 1 - (1 - 0.8 ** d) ** 16
        assert (reach >= 0.999) == (d == 4)
    assert ngram_join.prefix_depth(0.1, 2, 8, 0.999) == 1


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
    sig = ngram_join.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]), 512)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.08


def test_components_of_long_and_branched_graphs(spark):
    edges = [(f"n{i:04}", f"n{i + 1:04}") for i in range(300)] + [("x1", "x0"), ("x1", "x2"), ("y", "y")]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"n{i:04}"] for i in range(301)} == {"n0000"}
    assert got["x0"] == got["x1"] == got["x2"] == "x0" and "y" not in got


def bench_words(text):
    import re
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


@pytest.fixture(scope="module")
def leak_docs(spark, sf, odd_texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").collect()]
    clean = odd_texts[3][1]
    docs = list(odd_texts)
    for k, (_, text) in enumerate(items[:20]):
        w = text.split()
        docs.append((6000 + k, f"{clean} {text} {clean}"))
        docs.append((6100 + k, " ".join(w[:-1])))
        w[len(w) // 2] = "changed"
        docs.append((6200 + k, f"{clean[:300]}\n{' '.join(w)}"))
        docs.append((6300 + k, text.upper().replace(" ", "  ")))
        docs.append((6400 + k, " ".join(text.split()[: len(w) // 2])))
    return items, docs + [docs[-3]]


def test_leaks_match_brute_force(spark, make_docs, no_docs, leak_docs):
    items, docs = leak_docs
    bench = spark.createDataFrame([*items, (900, None), (901, "too short"), (None, items[0][1])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(make_docs(docs), bench).collect()}
    want = {}
    grams = lambda w: Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    for item_id, text in [*items, (None, items[0][1])]:
        iw = bench_words(text)
        g = grams(iw)
        at = defaultdict(list)
        for o in range(len(iw) - 4):
            at[tuple(iw[o:o + 5])].append(o)
        for doc_id, t in docs:
            w = bench_words(t)
            starts = {max(0, min(p - o, len(w) - len(iw))) for p in range(len(w) - 4) for o in at.get(tuple(w[p:p + 5]), ())}
            for s in starts:
                v = grams(w[s:s + len(iw)])
                sim = sum((g & v).values()) / sum((g | v).values())
                if sim >= 0.8:
                    want[(doc_id, item_id)] = max(sim, want.get((doc_id, item_id), 0))
    exact = {k for k, s in want.items() if s >= 0.9}
    assert exact <= set(got) <= set(want)
    assert len(got) >= 0.95 * len(want) > 40  # a fingerprint beyond the radius may cost a weaker one
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got if k in exact)
    assert decontaminate.find_leaks(no_docs, bench).count() == 0
    assert decontaminate.find_leaks(make_docs(docs[:3]), bench.limit(0)).count() == 0


def test_decontaminated_rows(spark, make_docs, leak_docs):
    items, docs = leak_docs
    bench = spark.createDataFrame(items, "item_id long, text string")
    source = make_docs(docs)
    kept = decontaminate.decontaminate(source, bench)
    assert kept.columns == source.columns
    left = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert not set(left) & {6000 + k for k in range(20)} and {6400 + k for k in range(20)} <= set(left)
    assert sum(i is None for i in left) == 2 and left.count(7) == 2


def test_index_loses_no_pair_within_the_radius(spark):
    """All pairs of windows and items, by distance: those within 15 of one size and only they are met."""
    rng = np.random.default_rng(9)
    items = [(i, int(rng.integers(5, 7)), int(x)) for i, x in enumerate(rng.integers(-(1 << 63), 1 << 63, 40))]
    windows = []
    for w in range(600):
        _, n, fp = items[w % 40]
        for bit in rng.choice(64, int(rng.integers(0, 20)), replace=False):
            fp ^= -(1 << 63) if bit == 63 else 1 << int(bit)
        windows.append((w, n if w % 5 else 11 - n, fp))
    got = decontaminate.within_radius(spark.createDataFrame(windows, "window int, n int, fp long"),
                                      spark.createDataFrame(items, "item_id int, n int, item_fp long")).collect()
    want = {(w, i): (a ^ b) & (1 << 64) - 1 for w, n, a in windows for i, m, b in items if n == m}
    want = {k: x.bit_count() for k, x in want.items() if x.bit_count() <= 15}
    assert len(got) == len(want) > 200 and {(r["window"], r["item_id"]): r["distance"] for r in got} == want


def test_a_leak_takes_only_its_own_row(spark, leak_docs):
    item = leak_docs[0][0][1]
    rows = [(None, item), (None, "some other words that stand in no item at all"), (5, item), (5, "yet another clean text of a few words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((r["text"] for r in decontaminate.decontaminate(docs, bench).collect())) == sorted(rows[i][1] for i in (1, 3))


def test_shuffled_joins_find_the_same(spark, make_docs, leak_docs, monkeypatch):
    items, docs = leak_docs
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(str, decontaminate.find_leaks(make_docs(docs), bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(str, decontaminate.find_leaks(make_docs(docs), bench).collect())) == want and len(want) > 40


def test_forest_joins_all_equal_prefixes(spark, monkeypatch):
    """Components of the links are those of all pairs that agree in ``depth`` values, with runs over heads, batches and tasks."""
    monkeypatch.setattr(ngram_join, "LINKED", 3)
    rng = np.random.default_rng(8)
    keys = rng.integers(0, 3, (300, 2, 8)).astype(np.uint64)
    keys[:80, 0] = keys[0, 0]  # one long run
    packed = np.zeros((300, 2, 2), np.uint64)
    for d in range(8):
        packed[:, :, d // 4] |= keys[:, :, d] << np.uint64(48 - 16 * (d % 4))
    rows = [(f"n{i:03}", [int(x) for x in packed[i].view(np.int64).ravel()]) for i in range(300)]
    df = spark.createDataFrame(rows, "node string, keys array<long>").repartition(5)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        for depth in (8, 6, 5, 4):
            found = ngram_join.forest_links(df, 2, depth)
            got = {r["node"]: r["root"] for r in components(found).collect()}
            root = list(range(300))
            groups = defaultdict(list)
            for i in range(300):
                for t in range(2):
                    groups[(t, *keys[i, t, :depth])].append(i)
            while True:
                new = list(root)
                for g in groups.values():
                    low = min(new[i] for i in g)
                    for i in g:
                        new[i] = low
                if new == root:
                    break
                root = new
            want = {f"n{i:03}": f"n{root[i]:03}" for i in range(300) if root.count(root[i]) > 1}
            assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_keys_hold_the_values_in_order():
    sig = np.random.default_rng(2).integers(0, 1 << 32, (5, 16)).astype(np.uint32)
    sig[1] = sig[0]
    sig[1, 5] ^= np.uint32(1 << 20)
    key = ngram_join.keys_of(sig, 2, 8)
    tree, hi, lo = np.zeros(5, np.int64), key[:, 0, 0].view(np.int64).copy(), key[:, 0, 1].view(np.int64).copy()
    agree = [(ngram_join.prefixes(tree, hi, lo, d)[0] == ngram_join.prefixes(tree, hi, lo, d)[1]).all() for d in range(1, 9)]
    assert agree == [True] * 5 + [False] * 3


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs of similarity just above 0.8: at least 99 in 100 are found."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(300):
        w = [f"w{x}" for x in rng.integers(0, 10**6, 94)]
        v = w[:84] + [f"v{x}" for x in rng.integers(0, 10**6, 6)]  # 80 of 90 and 86 shingles: 80 / 96
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r["n_text_links"] == 1 for r in got) >= 0.99 * 600 and max(r["n_text_links"] for r in got) == 1


def test_links_of_a_group_of_near_copies_are_few(spark):
    """Most links of a large group are the same in all trees (with heads by position: over six for each text)."""
    rng = np.random.default_rng(12)
    sig = np.repeat(rng.integers(0, 1 << 32, (1, 128)).astype(np.uint32), 2000, axis=0)
    other = rng.random(sig.shape) < 0.1  # values that a changed word replaces
    sig[other] = rng.integers(0, 1 << 32, int(other.sum())).astype(np.uint32)
    key = ngram_join.keys_of(sig, 16, 8)
    rows = [(f"{int(d):08x}", [int(x) for x in key[i].view(np.int64).ravel()])
            for i, d in enumerate(rng.choice(1 << 31, 2000, replace=False))]
    found = ngram_join.forest_links(spark.createDataFrame(rows, "node string, keys array<long>"), 16, 4).where("a <> b")
    links = found.selectExpr("least(a, b)", "greatest(a, b)").distinct().count()
    assert 1999 <= links <= 4.5 * 2000
    got = components(found)
    assert got.count() == 2000 and got.select("root").distinct().count() == 1
