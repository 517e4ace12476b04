"""Token store and packing against plain use of the tokenizer."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiscope.llm import packing, token_store
from lexiscope.llm.tokenise import WordTokenizer, default_path


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(default_path())
    return lambda text, end: model.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_give_the_ids_of_the_text(plain, odd_texts):
    tok = WordTokenizer(default_path())
    for _, text in odd_texts:
        assert np.frombuffer(tok.encode(text), tok.dtype).tolist() == plain(text, 0)[:-1]


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text_gives_its_ids(plain, text):
    tok = WordTokenizer(default_path())
    assert np.frombuffer(tok.encode(text), tok.dtype).tolist() == plain(text, 0)[:-1]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    for n in (0, 1, 7, 8, 9, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
        planes = token_store.to_planes(ids, bits, zstandard.ZstdCompressor())
        assert len(planes) == (32 if bits else 4)
        assert token_store.from_planes(planes, n, zstandard.ZstdDecompressor()).tolist() == ids.tolist()


def test_store_round_trip(spark, make_docs, odd_texts, plain):
    # Small blocks: documents cross them, and one block holds several documents.
    path = token_store.write_store(make_docs(odd_texts), block_ids=1000)
    got = token_store.digests(spark, path).collect()
    whole = defaultdict(list)
    for i, text in odd_texts:
        ids = plain(text, token_store.END_ID)
        whole[i].append((len(ids), crc(ids)))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (i, *x) for i, xs in whole.items() for x in xs)
    at = 0
    order = sorted(got, key=lambda r: r["start"])
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in order]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_store_reads_back_bit_planes_and_empty(spark, make_docs, no_docs, odd_texts, plain):
    a = token_store.write_store(make_docs(odd_texts[:9]), bits=True)
    assert {(r["doc_id"], r["ids_crc32"]) for r in token_store.digests(spark, a).collect()} == {
        (i, crc(plain(t, 1))) for i, t in odd_texts[:9]}
    assert token_store.digests(spark, token_store.write_store(no_docs)).count() == 0


def check_packing(pieces, docs, plain, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    want = {}
    for i, text in docs:
        want.setdefault(i, []).append(plain(text, packing.END_ID))
    for r in pieces:
        ids = np.frombuffer(r["ids"], f"<u{r['width']}").tolist()
        assert len(ids) == r["length"] > 0
        by_doc[r["doc_id"]].append((r["start"], tuple(ids), r["doc_tokens"]))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(want)
    for i, got in by_doc.items():
        texts = want[i]
        if len(texts) == 1:
            whole = []
            for start, ids, n in sorted(got):
                assert start == len(whole) and n == len(texts[0])
                whole += ids
            assert whole == texts[0]
        else:  # several rows of one id: every token of each at its place
            assert Counter((s + k, x, n) for s, ids, n in got for k, x in enumerate(ids)) == Counter(
                (k, x, len(t)) for t in texts for k, x in enumerate(t))
    padding = used = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        used += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, used, by_seq


def test_packing_is_exact_and_tight(make_docs, no_docs, odd_texts, plain):
    pieces = packing.pack(make_docs(odd_texts)).collect()
    padding, used, _ = check_packing(pieces, odd_texts, plain, packing.CAPACITY)
    assert padding == 0 and used == sum(len(plain(t, 2)) for _, t in odd_texts)
    assert packing.pack(no_docs).count() == 0


def test_packing_uses_patterns(make_docs, plain, sf, spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] * 1
    pieces = packing.pack(make_docs(docs), capacity=1024, unit=64).collect()
    padding, _, by_seq = check_packing(pieces, docs, plain, 1024)
    assert padding == 0
    assert sum(len(p) > 1 for p in by_seq.values()) > 5


def test_column_generation_reaches_the_optimum():
    # 30 pieces of 50 and 30 of 30 in stock of 110: the relaxation's best is 19.2 and 2/11 patterns wide.
    solved = packing.solve_patterns(np.array([30, 50]), np.array([30.0, 30.0]), 110)
    made = sum(x * c for x, c in solved)
    assert np.all(made >= 30 - 1e-6)
    assert sum(x for x, _ in solved) <= 22.5 + 1e-6  # 15 of (2 x 50) leave 30 pieces of 30 at 4 each
    solved = packing.solve_patterns(np.array([3, 4, 5]), np.array([7.0, 9.0, 4.0]), 12)
    assert sum(x for x, _ in solved) == pytest.approx((3 * 7 + 4 * 9 + 5 * 4) / 12, abs=1e-6)


def test_knapsack_matches_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 9, 3))
        prices = rng.random(len(lengths))
        best, counts = packing.best_pattern(lengths, prices, 17)

        def brute(left, k):
            if k == len(lengths):
                return 0.0
            return max(n * prices[k] + brute(left - n * lengths[k], k + 1) for n in range(left // lengths[k] + 1))

        assert best == pytest.approx(brute(17, 0))
        assert counts @ lengths <= 17 and counts @ prices == pytest.approx(best)
