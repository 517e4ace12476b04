"""op12 against a plain search over whole conversations, cut into pieces of any size."""

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiscope.llm import conversation_repair as cr
from lexiscope.llm.queries import damaged, op12_conversation_repair

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    """conv_id -> rows after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv] += []
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).hexdigest()))
            for c, r in out.items()}


def search(rows, faults):
    """The least (cost, audit) by row and state, forwards; the state is what the emitted initials end in."""
    def follow(state, c):  # "" start, then the last initial
        return c if (state, c) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")} else None

    def grow(best):  # insertions
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for who in ("user", "assistant"):
                    to = follow(state, who[0])
                    new = (cost + 2, audit + "I", out + [(who, "")])
                    if to and (to not in best or new[:2] < best[to][:2]):
                        best[to] = new
        return best

    best = grow({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, out) in best.items():
            options = [(state, (cost + 3, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (to := follow(state, role[:1])):
                    options.append((to, (cost + more, audit + "K", out + [(role, text)])))
                for who in ("user", "assistant"):
                    if (to := follow(state, who[0])):
                        options.append((to, (cost + 2 + more, audit + "R", out + [(who, text)])))
            for to, new in options:
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        best = grow(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def plain(conversations):
    out = []
    for conv, rows in conversations.items():
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.rstrip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, kept = search(rows, faults)
        assert PATTERN.fullmatch("".join(role[0] for role, _ in kept))
        turns = [t for t, _, _ in rows if t is not None]
        initials = [role[:1] for _, role, _ in rows]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                    faults.count("duplicate"), faults.count("truncated"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture()
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def use(n):
        spark.conf.set(key, n)
    yield use
    spark.conf.set(key, before)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("*", *[F.lit("clash").alias(c) for c in ("conv", "place", "kind", "h", "codes", "cost", "state", "key", "copy")])


def results(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_up(n, seed=0, length=12):
    rng = np.random.default_rng(seed)
    texts = ["One.", "Two!", "cut off", "", " \t", "three?", "x" * 300 + ".", "a\nb.", "é中.", "dot . "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", "a", None]
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(0, length))):
            rows.append((c, int(rng.integers(0, 20)) if rng.random() < 0.2 else 2 * t, roles[rng.integers(len(roles))] if rng.random() < 0.4
                         else ("user", "assistant")[t % 2], texts[rng.integers(len(texts))] if rng.random() < 0.4 else f"text {t}."))
    return rows


def odd_rows():
    rows = made_up(40)
    rows += [(None, 1, "user", "No id."), (None, None, "assistant", None), (500, None, None, None), (501, None, "user", "Hi."),
             (501, 3, "assistant", "Ho."), rows[0], rows[0], rows[3], (502, 1, "user", "long " * 40_000 + "."),
             (502, 2, "assistant", "Yes."), (503, -7, "system", "s."), (503, 9, "user", "u")]
    return rows + [(504, t, "user" if t % 2 else "assistant", "Same.") for t in range(30)]


@pytest.mark.parametrize("batch", [2000, 7, 1])
def test_equals_the_plain_search(spark, small_batches, batch):
    rows = odd_rows()
    small_batches(batch)
    assert results(cr.audits(damaged(frame(spark, rows)))) == plain(plain_damage(rows))


@pytest.mark.parametrize("passes", [cr.PASSES, 0])
def test_one_long_conversation_in_many_pieces(spark, small_batches, passes, monkeypatch):
    monkeypatch.setattr(cr.end_costs, "__defaults__", (passes,))
    small_batches(16)
    rng = np.random.default_rng(1)
    rows = [(1, t, ("user", "assistant", "tool")[rng.integers(3)], f"Text {rng.integers(150)}{'.!, '[rng.integers(4)]}") for t in range(400)]
    rows += [(2, t, "tool", f"Number {t}.") for t in range(150)]  # steps that only permute states never converge
    rows += [(3, t, "user", "Again.") for t in range(90)] + [(4, t, "user", " ") for t in range(60)]
    assert results(cr.audits(damaged(frame(spark, rows)))) == plain(plain_damage(rows))


def test_fix_up_passes_and_doubling_agree(spark):
    rng = np.random.default_rng(2)
    for kinds in (list(range(11)), [9, 10], [5, 7, 9], [1, 2, 0]):
        rows = [("c", i, 9, bytearray(rng.choice(kinds, 5).astype(np.uint8).tobytes())) for i in range(9)]
        df = spark.createDataFrame(rows, "conv string, idx long, size long, codes binary")
        whole = cr.backward(b"".join(bytes(r[3]) for r in rows), cr.ENDS)
        for found in (cr.end_costs(df, 12), cr._by_doubling(df), cr.end_costs(df, 1)):
            for r in found.collect():
                want = whole[5 * (r.idx + 1)]
                assert len({a - b for a, b in zip(r.end, want)}) == 1, (kinds, r.idx)


def test_all_short_conversations():
    """Every sequence of up to four coded rows, against the plain search."""
    kinds = {0: None, 1: ("user", ""), 3: ("system", "s."), 4: ("system", "s"), 5: ("user", "u."), 6: ("user", "u"),
             7: ("assistant", "a."), 9: ("tool", "t.")}
    for n in range(5):
        for codes in product(kinds, repeat=n):
            rows = [(0, *kinds[c]) for c in codes if kinds[c]]
            faults = ["blank" if not t else "" if t[-1] == "." else "truncated" for _, _, t in rows]
            edits, cost, state = cr.trace(bytes(codes), cr.backward(bytes(codes), cr.ENDS), 0, True)
            assert state in (0, 3)
            assert (cost, "".join(e[0] for e in edits)) == search(rows, faults)[:2]


def test_repaired_rows_are_those_of_the_hash(spark, small_batches):
    rows = odd_rows()
    for batch in (2000, 5):
        small_batches(batch)
        given = damaged(frame(spark, rows))
        by = defaultdict(list)
        for r in cr.repaired(given).orderBy("piece", "position").collect():
            by[r.conv_id].append(r)
        for r in cr.audits(given).collect():
            assert "".join(e.edit for e in by[r.conv_id]) == r.audit
            text = "\n".join(f"{e.role}:{e.text}" for e in by[r.conv_id] if e.edit != "D")
            assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


def test_absent_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, 1, "user", "Hi.", True), (1, 2, "user", "Ho.", True), (2, 5, "user", "A.", False),
                                  (2, 6, "assistant", "B.", None)], "conv_id long, turn long, role string, text string, absent boolean")
    nothing = hashlib.sha256(b"").hexdigest()
    assert results(cr.audits(rows)) == [(1, 0, 0, 0, 0, 0, 0, "", nothing), (2, 0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(
        b"user:A.\nassistant:B.").hexdigest())]
    assert results(cr.audits(rows.where("false"))) == [] and cr.repaired(rows.where("false")).count() == 0


def test_query_over_the_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(op12_conversation_repair(spark, sf)) == plain(plain_damage(rows))
