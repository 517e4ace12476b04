"""Repair of conversation structure by a rank-convergence parallel Viterbi search.

A repaired conversation has role initials ``(s?(ua)+)?``.  Its rows are kept (0), given another role (2) or deleted (3,
which blank and duplicate rows must be), empty user or assistant rows are inserted (2), and a truncated row
that stays costs 1 more.  Seen from the end, a row maps the four costs of finishing from each state (nothing yet, after
a system, a user, an assistant row) to the four costs before it: one min-plus step.

All rows are range-partitioned by conversation and turn, so a conversation of any length is a sequence of pieces, each
within one Arrow batch.  A conversation inside one batch is settled there.  The others' pieces keep one code a row:

* a row is a duplicate if its piece, or by a join of each piece's different rows an earlier one, holds it already;
* every piece runs from a speculative vector of end costs; fix-up passes run a piece again from its successor's start
  costs until these differ from what it has used by a constant only (then nothing it decided can change).  Where
  passes do not converge (steps that only permute states), the pieces' 4 x 4 matrices are multiplied by doubling;
* forward, each piece tells which state it leaves in for each state it is entered in; from the true one it traces the
  ASCII-least of the cheapest edits by its backward costs.

SHA-256 can't be cut: the pieces' repaired rows pass in order through one streaming task for each such conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiscope.llm.common import WHITE, ready, written
from lexiscope.plans.ordering import indexed_scan

REROLE, DELETE, INSERT, STAYS_TRUNCATED = 2, 3, 2, 1
#: Fix-up passes before doubling takes over.
PASSES = 12
NEVER = 1 << 50
#: States: nothing yet, after a system, a user, an assistant row; the state after a row that is added in each.
NEXT = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}
#: Codes of rows: absent (dropped before), blank, duplicate, else FREE + 2 * initial + truncated.
ABSENT, BLANK, DUPLICATE, FREE = 0, 1, 2, 3
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}


def closed(v: list[int]) -> tuple[int, int, int, int]:
    """Costs of finishing where rows may be inserted first."""
    user, assistant = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return min(v[0], INSERT + user), min(v[1], INSERT + user), user, assistant


ENDS = closed([0, NEVER, NEVER, 0])


def keeps(state: int, initial: int) -> int:
    """The state after keeping a row, 0 if its initial can't follow."""
    if initial == 0:
        return 1 if state == 0 else 0
    return NEXT[state] if initial in (1, 2) and NEXT[state] == initial + 1 else 0


def _step(code: int) -> tuple[list[list[tuple[int, int]]], int]:
    initial, truncated = divmod(code - FREE, 2)
    options = []
    for state in range(4):
        kept = keeps(state, initial)
        options.append([(DELETE, state), (REROLE + STAYS_TRUNCATED * truncated, NEXT[state])]
                       + ([(STAYS_TRUNCATED * truncated, kept)] if kept else []))
    return options


#: For each code and state: (cost, next state) of deleting, rerolling and, where it can be, keeping the row.
STEPS = [None, None, None, *(_step(c) for c in range(FREE, FREE + 8))]


def backward(codes: bytes, end: tuple) -> list[tuple]:
    """Costs of finishing before each row and after the last."""
    out = [tuple(end)]
    for code in reversed(codes):
        v = out[-1]
        if code in (BLANK, DUPLICATE):
            v = (v[0] + DELETE, v[1] + DELETE, v[2] + DELETE, v[3] + DELETE)
        elif code != ABSENT:
            v = closed([min([cost + v[to] for cost, to in options]) for options in STEPS[code]])
        out.append(v)
    out.reverse()
    return out


def trace(codes: bytes, costs: list[tuple], state: int, last: bool) -> tuple[list[tuple], int, int]:
    """The ASCII-least cheapest edits ``(letter, row or None, role)`` from a state, their cost, the state after them.

    ``role`` is set for inserted and rerolled rows.  Rows inserted at the end belong to the ``last`` piece only."""
    edits, spent, i, n = [], 0, 0, len(codes)
    while i < n:
        code, here, after = codes[i], costs[i], costs[i + 1]
        if code == ABSENT:
            i += 1
            continue
        if code in (BLANK, DUPLICATE) or here[state] == DELETE + after[state]:
            edits.append(("D", i, None))
            spent, i = spent + DELETE, i + 1
            continue
        to = NEXT[state]
        if here[state] == INSERT + here[to]:
            edits.append(("I", None, ROLE_OF[to]))
            spent, state = spent + INSERT, to
            continue
        initial, truncated = divmod(code - FREE, 2)
        kept = keeps(state, initial)
        if kept and here[state] == STAYS_TRUNCATED * truncated + after[kept]:
            edits.append(("K", i, None))
            spent, state = spent + STAYS_TRUNCATED * truncated, kept
        else:
            edits.append(("R", i, ROLE_OF[to]))
            spent, state = spent + REROLE + STAYS_TRUNCATED * truncated, to
        i += 1
    while last and state in (1, 2):
        state = NEXT[state]
        edits.append(("I", None, ROLE_OF[state]))
        spent += INSERT
    return edits, spent, state


def codes_of(roles: list[str], texts: list[str], absent: list[bool]) -> tuple[bytes, list[int]]:
    """A code for each row, duplicates within these rows included, and the rows that are not among those."""
    codes, first, seen = bytearray(len(roles)), [], set()
    for i, (role, text, gone) in enumerate(zip(roles, texts, absent)):
        if gone:
            continue
        bare = text.rstrip(WHITE)
        if not bare:
            codes[i] = BLANK
        elif (role, text) in seen:
            codes[i] = DUPLICATE
        else:
            seen.add((role, text))
            first.append(i)
            initial = INITIALS.index(role[0]) if role and role[0] in INITIALS else len(INITIALS)
            codes[i] = FREE + 2 * initial + (bare[-1] not in ".!?")
    return bytes(codes), first


def settle(codes: bytes, turns: list, roles: list[str], texts: list[str], end: tuple, state: int, last: bool) -> dict:
    """A piece's part of its conversation's result."""
    edits, cost, _ = trace(codes, backward(codes, end), state, last)
    there = [i for i, code in enumerate(codes) if code != ABSENT]
    initials = [roles[i][:1] for i in there]
    known = [turns[i] for i in there if turns[i] is not None]
    rows = [(letter, role or roles[i], "" if i is None else texts[i]) for letter, i, role in edits if letter != "D"]
    return {
        "blank": codes.count(BLANK), "duplicate": codes.count(DUPLICATE),
        "truncated": sum(code >= FREE and (code - FREE) % 2 for code in codes),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "n_rows": len(there), "begins": initials[0] if there else None, "ends": initials[-1] if there else None,
        "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
        "n_turns": sum(a != b for a, b in zip(known, [None, *known])),
        "cost": cost, "audit": "".join(letter for letter, _, _ in edits),
        "body": b"".join(f"\n{role}:{text}".encode() for _, role, text in rows),
        "edits": [(letter, role or (None if letter == "D" else roles[i]),
                   None if letter == "D" else "" if i is None else texts[i]) for letter, i, role in edits]}


class Joined:
    """A conversation's result from its pieces in order."""

    def __init__(self):
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "n_turns"), 0)
        self.audit, self.hash, self.empty = [], hashlib.sha256(), True
        self.least = self.most = self.ends = None

    def add(self, piece: dict) -> None:
        for name in self.sums:
            self.sums[name] += piece[name]
        if piece["n_rows"]:
            self.sums["illegal"] += self.ends is not None and self.ends + piece["begins"] not in LEGAL
            self.ends = piece["ends"]
        if piece["first_turn"] is not None:
            self.sums["n_turns"] -= piece["first_turn"] == self.most
            self.least = piece["first_turn"] if self.least is None else self.least
            self.most = piece["last_turn"]
        self.audit.append(piece["audit"])
        body = piece["body"]
        self.hash.update(body[1:] if self.empty else body)  # a row begins with its line break
        self.empty = self.empty and not body

    def result(self) -> dict:
        turns = self.sums.pop("n_turns")
        gaps = 0 if self.least is None else self.most - self.least + 1 - turns
        return {"gaps": gaps, **self.sums, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


PIECE = ("blank long, duplicate long, truncated long, illegal long, n_rows long, begins string, ends string, "
         "first_turn long, last_turn long, n_turns long, cost long, audit string, body binary, "
         "edits array<struct<edit: string, role: string, text: string>>")
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_EDITS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
_PIECE = {"begins": pa.string(), "ends": pa.string(), "audit": pa.string(), "body": pa.binary(), "edits": _EDITS}
_RESULT = {"audit": pa.string(), "repaired_sha256": pa.string()}


def _names(schema: str, types: dict) -> list[tuple[str, pa.DataType]]:
    fields = ["edits"] if "edits" in schema else []
    plain = schema.split(", edits")[0]
    return [(name, types.get(name, pa.int64())) for name in [f.split()[0] for f in plain.split(", ")] + fields]


def _cut(with_edits: bool):
    """Sorted rows to settled conversations, and to open pieces at a batch's ends."""
    fields = [*_names(RESULT, _RESULT), ("edits", _EDITS), ("place", pa.int64()), ("turns", pa.list_(pa.int64())),
              ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("codes", pa.binary()),
              ("first", pa.list_(pa.struct([("key", pa.binary()), ("row", pa.int32())])))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            n, ids, conv = batch.num_rows, batch.column("conv_id"), batch.column("conv").to_pylist()
            turns, roles = batch.column("turn").to_pylist(), batch.column("role").to_pylist()
            texts, absent = batch.column("text").to_pylist(), batch.column("absent").to_pylist()
            begin = [i for i in range(n) if not i or conv[i] != conv[i - 1]] + [n]
            out = {name: [] for name, _ in fields}
            for a, b in zip(begin, begin[1:]):
                t, r, x = turns[a:b], roles[a:b], texts[a:b]
                codes, first = codes_of(r, x, absent[a:b])
                row = {}
                if a and b < n:
                    piece = settle(codes, t, r, x, ENDS, 0, True)
                    whole = Joined()
                    whole.add(piece)
                    row = whole.result() | ({"edits": piece["edits"]} if with_edits else {})
                else:
                    keys = [{"key": hashlib.sha256(f"{len(r[i])}:{r[i]}{x[i]}".encode()).digest(), "row": i} for i in first]
                    row = {"place": place, "turns": t, "roles": r, "texts": x, "codes": codes, "first": keys}
                for name in out:
                    out[name].append(row.get(name))
                place += 1
            heads = [batch.column(name).take(pa.array(begin[:-1], pa.int64())) for name in ("conv_id", "conv")]
            yield pa.RecordBatch.from_arrays(
                heads + [_array(out[name], kind) for name, kind in fields], ["conv_id", "conv", *out])
    return run


def _array(values: list, kind: pa.DataType) -> pa.Array:
    if kind == _EDITS:
        values = [None if v is None else [dict(zip(("edit", "role", "text"), e)) for e in v] for v in values]
    return pa.array(values, kind)


LONGS = T.ArrayType(T.LongType())


@F.pandas_udf(LONGS)
def start_costs(codes: pd.Series, end: pd.Series) -> pd.Series:
    """Costs before a piece from those after it; null for null codes."""
    return pd.Series([None if c is None else list(backward(c, tuple(int(x) for x in e))[0]) for c, e in zip(codes, end)])


@F.pandas_udf(LONGS)
def leaves(codes: pd.Series, end: pd.Series, last: pd.Series) -> pd.Series:
    """The state after a piece for each state before it."""
    out = []
    for c, e, final in zip(codes, end, last):
        costs = backward(c, tuple(int(x) for x in e))
        out.append([trace(c, costs, s, bool(final))[2] for s in range(4)])
    return pd.Series(out)


@F.pandas_udf(LONGS)
def matrices(codes: pd.Series) -> pd.Series:
    """A piece's 4 x 4 min-plus matrix: costs before it by the one state that may come after it, state after state."""
    units = [tuple(0 if j == k else NEVER for j in range(4)) for k in range(4)]
    return pd.Series([[int(x) for unit in units for x in backward(c, unit)[0]] for c in codes])


@F.pandas_udf(LONGS)
def products(a: pd.Series, b: pd.Series) -> pd.Series:
    """Min-plus products of matrices, or the first matrix where there is no second."""
    out = []
    for x, y in zip(a, b):
        if y is not None:
            p, q = np.asarray(x).reshape(4, 4), np.asarray(y).reshape(4, 4)
            x = np.minimum(NEVER, (q[:, :, None] + p[None, :, :]).min(axis=1)).ravel()
        out.append([int(v) for v in x])
    return pd.Series(out)


@F.pandas_udf(T.BinaryType())
def marked(codes: pd.Series, rows: pd.Series) -> pd.Series:
    """Codes with some rows marked as duplicates."""
    out = []
    for c, again in zip(codes, rows):
        c = bytearray(c)
        for i in again if again is not None else []:
            c[i] = DUPLICATE
        out.append(bytes(c))
    return pd.Series(out)


def _vector(values: tuple) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def end_costs(pieces: DataFrame, passes: int = PASSES) -> DataFrame:
    """``conv, idx, size, codes`` with ``end``, the costs after each piece but for a constant."""
    last = F.col("idx") == F.col("size") - 1
    end = F.when(last, _vector(ENDS)).otherwise(_vector((0, 0, 0, 0)))  # speculative
    now = pieces.withColumn("end", end)
    now = written(now.withColumn("start", start_costs("codes", "end")), "repair-costs")
    for _ in range(passes):
        successor = now.select("conv", (F.col("idx") - 1).alias("idx"), F.col("start").alias("true"))
        off = [F.col("true")[k] - F.col("end")[k] for k in range(4)]
        stale = F.coalesce((off[0] != off[1]) | (off[0] != off[2]) | (off[0] != off[3]), F.lit(False))
        now = now.join(successor, ["conv", "idx"], "left").withColumn("again", stale)
        now = now.withColumn("end", F.when(F.col("again"), F.col("true")).otherwise(F.col("end")))
        rerun = start_costs(F.when(F.col("again"), F.col("codes")), F.col("end"))
        now = written(now.withColumn("start", F.coalesce(rerun, "start")).drop("true"), "repair-costs")
        if not now.where("again").limit(1).count():
            return now.select("conv", "idx", "size", "codes", "end")
        now = now.drop("again")
    return _by_doubling(pieces)


def _by_doubling(pieces: DataFrame) -> DataFrame:
    """The same where passes don't converge: products of ever more pieces' matrices, doubled each round."""
    now = written(pieces.select("conv", "idx", "size", matrices("codes").alias("m"),
                                (F.col("idx") + 1).alias("upto")), "repair-products")
    while now.where("upto < size").limit(1).count():
        onward = now.select("conv", F.col("idx").alias("upto"), F.col("m").alias("m2"), F.col("upto").alias("upto2"))
        now = written(now.join(onward, ["conv", "upto"], "left").select(
            "conv", "idx", "size", products("m", "m2").alias("m"), F.coalesce("upto2", "upto").alias("upto")),
            "repair-products")
    start = F.array(*[F.least(*[F.col("m")[4 * k + s] + ENDS[k] for k in range(4)]) for s in range(4)])
    after = now.select("conv", (F.col("idx") - 1).alias("idx"), start.alias("end"))
    return written(pieces.join(after, ["conv", "idx"], "left").withColumn(
        "end", F.coalesce("end", _vector(ENDS))).select("conv", "idx", "size", "codes", "end"), "repair-costs")


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces with the state in which each is entered."""
    conv = state = None
    for batch in batches:
        states = []
        for c, to in zip(batch.column("conv").to_pylist(), batch.column("leaves").to_pylist()):
            state, conv = state if c == conv else 0, c
            states.append(state)
            state = to[state]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("idx"), pa.array(states, pa.int64())],
                                         ["conv", "idx", "state"])


def _settled(with_edits: bool):
    fields = _names(PIECE, _PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():  # a piece may be as large as a batch of rows
                piece = settle(r["codes"], r["turns"], r["roles"], r["texts"], tuple(r["end"]), r["state"],
                               r["idx"] == r["size"] - 1)
                piece["edits" if not with_edits else "body"] = None
                heads = batch.slice(0, 0).schema
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[name]], heads.field(name).type) for name in ("conv_id", "conv", "idx")]
                    + [_array([piece[name]], kind) for name, kind in fields],
                    ["conv_id", "conv", "idx", *(name for name, _ in fields)])
    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted settled pieces to one result for each conversation."""
    fields, conv, head, whole = _names(RESULT, _RESULT), None, None, None

    def done():
        row = whole.result()
        return pa.RecordBatch.from_arrays([head, *(pa.array([row[name]], kind) for name, kind in fields)],
                                          ["conv_id", *(name for name, _ in fields)])

    for batch in batches:
        ids = batch.column("conv_id")
        for i, r in enumerate(batch.drop_columns(["conv_id"]).to_pylist()):
            if whole is None or r["conv"] != conv:
                if whole is not None:
                    yield done()
                conv, head, whole = r["conv"], ids.slice(i, 1), Joined()
            whole.add(r)
    if whole is not None:
        yield done()


def _repair(conversations: DataFrame, with_edits: bool) -> tuple[DataFrame, DataFrame]:
    """Conversations settled within a batch, and the settled pieces of the others."""
    spark = conversations.sparkSession
    ready(spark)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    gone = F.coalesce(F.col("absent"), F.lit(False)) if "absent" in conversations.columns else F.lit(False)
    rows = conversations.select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("absent"))
    # Rows alike in all columns are interchangeable; the last key lets them part.
    rows = rows.withColumns({"h": F.sha2("text", 256), "apart": F.xxhash64(F.monotonically_increasing_id())})
    order = ["conv", "turn", "role", "h", "apart"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("h", "apart")
    cut = written(ranged.mapInArrow(_cut(with_edits), (
        f"conv_id {kind}, conv string, {RESULT}, edits array<struct<edit: string, role: string, text: string>>, place long, "
        "turns array<bigint>, roles array<string>, texts array<string>, codes binary, "
        "first array<struct<key: binary, row: int>>")), "repair-cut")
    whole = cut.where("place is null")
    open_ = cut.where("place is not null")

    found = open_.select("conv", "place", F.explode("first").alias("f")).select("conv", "place", "f.key", "f.row")
    least = found.groupBy("conv", "key").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = found.join(least.drop("n"), ["conv", "key"]).where("place > least").groupBy("conv", "place").agg(
        F.collect_list("row").alias("again"))  # rows of one piece
    placed = indexed_scan(open_.select("conv", "place"), "conv", ["place"]).withColumnRenamed("group_size", "size")
    light = written(open_.select("conv", "place", "codes").join(placed, ["conv", "place"]).join(
        again, ["conv", "place"], "left").select("conv", "place", "idx", "size", marked("codes", "again").alias("codes")),
        "repair-codes")
    known = end_costs(light.select("conv", "idx", "size", "codes"))
    leaving = known.select("conv", "idx", leaves("codes", "end", F.col("idx") == F.col("size") - 1).alias("leaves"))
    state = leaving.repartition("conv").sortWithinPartitions("conv", "idx").mapInArrow(
        _entered, "conv string, idx long, state long")
    facts = known.join(state, ["conv", "idx"]).join(light.select("conv", "idx", "place"), ["conv", "idx"])
    asked = open_.select("conv_id", "conv", "place", "turns", "roles", "texts").join(facts, ["conv", "place"])
    pieces = written(asked.mapInArrow(_settled(with_edits), f"conv_id {kind}, conv string, idx long, {PIECE}"),
                     "repair-pieces")
    return whole, pieces


def audits(conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` (null: one conversation) of rows ``conv_id, turn, role, text``.

    ``gaps`` (turn numbers missing between the least and greatest; null turns aside), ``blank, duplicate, truncated``
    (rows by their first fault), ``illegal`` (adjacent role initials other than su, ua, au), ``cost`` and ``audit`` of the
    cheapest repair (edits' initials in order, ASCII-least of the cheapest) and ``repaired_sha256`` of its rows
    ``role:text`` joined by line breaks.  Rows count in order of turn (nulls first), then role, then the text's
    SHA-256; rows alike in all of these are one after another.  A null role or text is one space; a role with another
    initial than s, u, a can only be rerolled or deleted.  A true ``absent`` marks a row that is not there but whose
    conversation is; a conversation without others has zeros, an empty audit and the hash of nothing.  Other
    columns are ignored; no rows give no rows.
    """
    whole, pieces = _repair(conversations, False)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    joined = pieces.drop("edits").repartition("conv").sortWithinPartitions("conv", "idx").mapInArrow(
        _joined, f"conv_id {kind}, {RESULT}")
    return whole.select(joined.columns).unionByName(joined)


def repaired(conversations: DataFrame) -> DataFrame:
    """The repairs themselves: ``conv_id, piece, position, edit, role, text`` in order of ``piece``, ``position``; a
    deleted row has neither role nor text.  Input as for :func:`audits`."""
    whole, pieces = _repair(conversations, True)
    each = whole.select("conv_id", F.lit(0).cast("long").alias("piece"), F.posexplode("edits").alias("position", "e"))
    rest = pieces.select("conv_id", F.col("idx").alias("piece"), F.posexplode("edits").alias("position", "e"))
    return each.unionByName(rest).select("conv_id", "piece", "position", "e.*")
