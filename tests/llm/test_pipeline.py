"""The pipeline's run, each stage's decisions against brute force over the rows that its predecessor left."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lexiscope.llm import language_id, queries, secret_scan

WHITE = " \t\n\x0b\f\r"
LOWER = {i: i + 32 for i in range(65, 91)}


def split_words(text, lower=lambda s: s.translate(LOWER)):
    for ch in WHITE[1:]:
        text = text.replace(ch, " ")
    return [lower(w) for w in text.split(" ") if w]


def grams(words):
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def letters_only(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


@pytest.fixture(scope="module")
def ran(spark, sf, tmp_path_factory):
    """Rows before each stage, by its name, and the pipeline's result, over real and planted documents."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    source = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in source.orderBy("doc_id").collect()]
    names = source.columns
    items = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id")
    texts = {r["item_id"]: r["text"] for r in items.collect()}
    body = rows[11][names.index("text")]
    changed = body.split(" ")
    changed[len(changed) // 2] = "otherwise"
    half = lambda k: rows[k][names.index("text")][:len(rows[k][names.index("text")]) // 2]
    planted = [body, body, " ".join(changed), None, "", "12 34 !!", f"{body[:400]} {texts[min(texts)]} {body[-300:]}",
               f'{half(17)} password = "hunter2hunter2" and {"deadbeef" * 4} end {half(23)}',
               rows[20][names.index("text")] * 40]
    extra = [tuple(100_000 + k if c == "doc_id" else t if c == "text" else None for c in names) for k, t in enumerate(planted)]
    spark.createDataFrame(rows + extra, source.schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")

    before, stages = {}, list(corpus_pipeline.STAGES)

    def watched(name, stage):
        def run(spark, docs, sf_dir):
            before[name] = docs
            return stage(spark, docs, sf_dir)
        return name, run

    corpus_pipeline.STAGES = [watched(*s) for s in stages]
    try:
        result = corpus_pipeline.run(spark, folder)
    finally:
        corpus_pipeline.STAGES = stages
    held = {name: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()] for name, df in before.items()}
    assert all(df.columns == names for df in before.values())
    return folder, held, [r.asDict() for r in result.collect()], texts


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "secrets", "packing"]


def test_language_keeps_what_is_recognised(spark, ran):
    folder, held, _, _ = ran
    said = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in queries.op5_language_id(spark, folder).collect()}
    want = Counter(x for x in held["language"] if said[x[0]][0] != "und" and said[x[0]][1] >= language_id.MIN_SCORE)
    assert Counter(held["near_duplicates"]) == want
    assert not {100_003, 100_004, 100_005} & {i for i, _ in want} and len(want) > 0.8 * len(held["language"])


def test_one_document_of_each_group_stays(ran):
    _, held, _, _ = ran
    rows = held["near_duplicates"]
    sets = [set(grams(w)) or ({tuple(w)} if w else set()) for w in (split_words(t or "") for _, t in rows)]
    meets = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            meets[g].add(i)
    group = list(range(len(rows)))
    for i, s in enumerate(sets):
        for j in set().union(*(meets[g] for g in s)) if s else ():
            if 5 * len(s & sets[j]) >= 4 * len(s | sets[j]) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if x == old else x for x in group]
    best = {}
    for k, g in enumerate(group):
        best[g] = min(best.get(g, k), k, key=lambda x: rows[x][0])
    assert Counter(held["benchmark"]) == Counter(rows[k] for k in best.values())
    assert not {100_000, 100_001, 100_002} & {i for i, _ in held["benchmark"]}


def test_leaks_go_and_clean_documents_stay(ran):
    _, held, _, texts = ran
    most = {}
    items = [(len(w), Counter(grams(w))) for w in map(letters_only, texts.values())]
    for row in held["benchmark"]:
        w = letters_only(row[1])
        g = grams(w)
        most[row] = 0.0
        for n, item in items:
            for p in [p for p, x in enumerate(g) if x in item]:
                for s in range(max(0, p - n + 1), min(p, max(0, len(w) - n)) + 1):
                    v = Counter(g[s:s + n - 4])
                    most[row] = max(most[row], sum((v & item).values()) / sum((v | item).values()))
    left = set(held["secrets"])
    assert left <= set(most) and len(held["secrets"]) == len(left)
    assert all((row in left) == (m < 0.8) for row, m in most.items() if m < 0.8 or m >= 0.9)
    assert 100_006 not in {i for i, _ in left}


def test_secrets_are_masked_and_nothing_else(ran):
    _, held, _, _ = ran
    was, now = dict(held["secrets"]), dict(held["packing"])
    assert was.keys() == now.keys() and len(held["packing"]) == len(now)
    for i, text in was.items():
        covered = np.zeros(len(text) + 1, bool)
        for rule in secret_scan.RULES:  # every rule over the whole text
            regex, at = re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0)), 0
            while m := regex.search(text, at):
                at = m.end()
                covered[m.start():at] |= len(m.group(rule.group)) >= rule.least
        if not covered.any():
            assert now[i] == text
        else:
            kept = "".join(c for c, hide in zip(text, covered) if not hide)
            assert now[i].replace("[SECRET]", "") == kept
    assert "hunter2" not in now[100_007] and "deadbeef" not in now[100_007] and now[100_007].count("[SECRET]") == 2


def test_pieces_hold_every_id_once(ran):
    _, held, pieces, _ = ran
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    of = defaultdict(list)
    for p in pieces:
        of[p["doc_id"]].append(p)
    assert of.keys() == dict(held["packing"]).keys()
    for i, text in held["packing"]:
        ids = []
        for p in sorted(of[i], key=lambda p: p["start"]):
            assert p["start"] == len(ids)
            ids += np.frombuffer(p["ids"], f"<u{p['width']}").tolist()
            assert len(ids) == p["start"] + p["length"]
        assert ids == tok.encode(text, add_special_tokens=False).ids + [2]
    ends = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends[p["sequence_id"]]
        ends[p["sequence_id"]] += p["length"]
    assert max(ends.values()) <= 4096
