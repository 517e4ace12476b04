"""Words that collide under polynomial hashes stay apart in every operator that hashes words."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiscope.llm import katz_lm, ngram_join, packing, token_store, word_hash
from lexiscope.llm.tokenise import WordTokenizer, default_path
from pyspark.sql import functions as F


def thue_morse(power):
    word = "a"
    for _ in range(power):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


PAIRS = [thue_morse(k) for k in (8, 9, 10, 11, 13)]


def test_hashes_of_constructed_words_differ():
    for one, other in PAIRS:
        _, _, h, where = next(word_hash.text_chunks(pa.array([f"{one} {other} {one}"])))
        assert h[0] != h[1] and h[0] == h[2] and where.tolist() == [0, 3]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters=" \t\n\x0b\f\r"), min_size=1, max_size=40), max_size=12))
def test_equal_words_and_only_they_have_equal_hashes(words):
    column = pa.array([" ".join(words), None, "\n".join(reversed(words))])
    parts = list(word_hash.text_chunks(column))
    h = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0)
    fold = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words + words[::-1]]
    assert len(h) == len(fold)
    assert [[a == b for b in fold] for a in fold] == [[a == b for b in h] for a in h]


def test_long_words_and_lane_ends():
    words = ["x" * n for n in (1, 7, 8, 9, 15, 16, 17, 511, 512, 513, 4000)] + ["x" * 513 + "y", "\0", "\0\0", "\0" * 8]
    _, _, h, _ = next(word_hash.text_chunks(pa.array([" ".join(words)])))
    assert len(set(h.tolist())) == len(words)


def test_words_of_one_hash_are_still_told_apart(monkeypatch):
    """Every hash is cut to two bits: the checks keep the ids right."""
    plain = word_hash.hash_bytes

    def coarse(data, begin, end):
        h, check = plain(data, begin, end)
        return h & np.uint64(3), check

    monkeypatch.setattr(word_hash, "hash_bytes", coarse)
    tok = WordTokenizer(default_path())
    for text in ("one two three four five six seven", "one", "two", "one", "seven, eight! nine", "", "three one"):
        assert np.frombuffer(tok.encode(text), tok.dtype).tolist() == tok.model.encode(text, add_special_tokens=False).ids


def test_kept_words_are_the_first_ones():
    tok = WordTokenizer(default_path())
    tok.encode("alpha beta gamma")
    tok.encode("delta epsilon")
    tok.shrink(3)
    assert len(tok.keys) == len(tok.check) == len(tok.number) == len(tok.begin) == 3 and (np.diff(tok.keys.astype(float)) > 0).all()
    for text in ("gamma delta alpha", "epsilon beta zeta beta"):
        assert np.frombuffer(tok.encode(text), tok.dtype).tolist() == tok.model.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_path())


def test_tokens_and_sequences(spark, make_docs, model):
    docs = [(i, f"{a} {b}") for i, (a, b) in enumerate(PAIRS)]
    want = {i: model.encode(t, add_special_tokens=False).ids for i, t in docs}
    path = token_store.write_store(make_docs(docs))
    assert {r.doc_id: r.ids_crc32 for r in token_store.digests(spark, path).collect()} == {
        i: zlib.crc32(np.array(ids + [token_store.END_ID], "<u4").tobytes()) for i, ids in want.items()}
    got = {i: {} for i in want}
    for r in packing.pack(make_docs(docs)).collect():
        got[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], f"<u{r['width']}").tolist()
    assert {i: sum((parts[s] for s in sorted(parts)), []) for i, parts in got.items()} == {
        i: ids + [packing.END_ID] for i, ids in want.items()}


def test_unknown_words_stay_unknown(spark, make_docs):
    one, other = PAIRS[2]
    docs = make_docs([(1, f"{one} common"), (2, f"{one} {other}")])
    got = {r.doc_id: r for r in katz_lm.score_documents(docs, F.col("doc_id") == 2).collect()}
    assert got[1].n_known == 3 and got[2].n_known == 2  # the end counts


def test_different_texts_are_not_linked(spark, make_docs):
    docs = make_docs([(2 * k + j, " ".join([w] * 8)) for k, pair in enumerate(PAIRS) for j, w in enumerate(pair)])
    got = ngram_join.near_duplicates(docs).collect()
    assert all(r.class_id == r.doc_id and r.n_text_links == 0 for r in got) and len(got) == 2 * len(PAIRS)
    assert ngram_join.drop_near_duplicates(docs).count() == len(got)
