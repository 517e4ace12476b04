"""Packing of documents into fixed-length sequences by cutting-stock column generation.

Every document is cut at multiples of the capacity (each such chunk is a sequence
of its own); the rest is a *body* of whole units (``unit`` tokens) and a *tail* of
fewer than ``unit`` tokens.  The histogram of body lengths (at most capacity/unit
classes) and that of tail lengths (fewer than ``unit``) are two cutting-stock problems,
of a size that does not depend on the corpus:

* a linear program over patterns (how many pieces of each length fill one sequence)
  is solved by column generation: a revised simplex holds the basis, and a knapsack
  dynamic program over its dual prices finds the next pattern or proves optimality;
* the rounded patterns that fill a sequence exactly are assigned to documents by
  their rank within a length class, by arithmetic alone;
* what rounding leaves is laid end to end and cut where a sequence is full.  The
  last, partial sequence of such a stream is cut into power-of-two lengths, which need
  no padding.

Ranks come from running counts per written partition plus the counts of the
partitions before it, so the ids are tokenised and stored once and never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import ready, written
from lexiscope.llm.tokenise import default_path, texts, tokenizer, until_done

CAPACITY = 4096
UNIT = 16
END_ID = 2
#: Rows (one for each written partition and length class) up to which offsets are broadcast.
BROADCAST_ROWS = 2_000_000
TAIL = 1_000_000  # tail classes are numbered from here, body classes from 1, full chunks are 0


def best_pattern(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern within ``capacity``, as counts."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        m = int(np.searchsorted(lengths, c, side="right"))
        if m:
            value = prices[:m] + best[c - lengths[:m]]
            k = int(np.argmax(value))
            if value[k] > best[c] + 1e-12:
                best[c], pick[c] = value[k], k
    counts, c = np.zeros(len(lengths), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= int(lengths[pick[c]])
    return float(best[capacity]), counts


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[float, np.ndarray]]:
    """Basis of the linear program min sum(x) with patterns covering ``demand``: (x, counts) pairs."""
    k = len(lengths)
    per = capacity // lengths
    columns = [np.eye(k, dtype=np.int64)[i] * per[i] for i in range(k)]
    inverse, x = np.diag(1.0 / per), demand / per
    for _ in range(40 * k + 100):  # stopping early costs optimality only, never a piece
        value, column = best_pattern(lengths, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-9:
            break
        step = inverse @ column
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        theta = ratio[out]
        x = np.maximum(x - theta * step, 0)
        x[out] = theta
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
        columns[out] = column
    return sorted(zip(x.tolist(), columns), key=lambda p: -p[0])


def plan_rows(histogram: dict[int, int], size: int, capacity: int, first: int, slot0: int) -> tuple[list, int, tuple]:
    """Where each rank of each class goes, the next free sequence id, and the stream's end
    (its full sequences, and the power-of-two cuts after them).

    ``histogram``: pieces per class, class c being ``c * size`` tokens long.  A row is
    ``(slot, lo, hi, mult, seq0, off0, length, base, stream)``: ranks in [lo, hi) go ``mult`` to
    a sequence from ``seq0`` on at offset ``off0``; with ``mult`` 0 they lie in the stream
    ``stream`` from token ``base`` on.
    """
    left = {c: n for c, n in sorted(histogram.items()) if n}
    rows, done, seq = [], dict.fromkeys(left, 0), first
    if left:
        lengths = np.array(list(left), np.int64)
        solved = solve_patterns(lengths, np.array(list(left.values()), float), capacity // size)
        for x, counts in solved:
            used = {int(lengths[i]): int(n) for i, n in enumerate(counts) if n}
            if not used or sum(c * n for c, n in used.items()) * size != capacity:
                continue
            times = min(int(np.ceil(x - 1e-9)), *(left[c] // n for c, n in used.items()))
            if times <= 0:
                continue
            off = 0
            for c, n in used.items():
                rows.append((slot0 + c, done[c], done[c] + times * n, n, seq, off, c * size, 0, 0))
                done[c] += times * n
                left[c] -= times * n
                off += n * c * size
            seq += times
    at = 0
    for c, n in left.items():
        if n:
            rows.append((slot0 + c, done[c], done[c] + n, 0, seq, 0, c * size, at, slot0))
            at += n * c * size
    rest, cuts = at % capacity, []
    while rest:  # powers of two, largest first
        cut = 1 << (rest.bit_length() - 1)
        cuts.append((at - rest, at - rest + cut, seq + at // capacity + len(cuts)))
        rest -= cut
    return rows, seq + at // capacity + len(cuts), (at // capacity, cuts)


def _items(path: str, end_id: int, capacity: int, unit: int):
    """Full chunks, body and tail of every text, each with its number within its class and partition."""
    def run(batches):
        tok, part = tokenizer(path), TaskContext.get().partitionId()
        width = tok.dtype.itemsize
        end, seen = np.array([end_id], tok.dtype).tobytes(), {}
        for batch in batches:
            rows = {k: [] for k in SCHEMA.names}
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), texts(tok, batch.column("text"))):
                ids = own.tobytes() + end
                n = len(ids) // width
                full, rest = divmod(n, capacity)
                body, tail = divmod(rest, unit)
                for slot, start, length in (*((0, i * capacity, capacity) for i in range(full)),
                                            (body, full * capacity, body * unit), (TAIL + tail, n - tail, tail)):
                    if length:
                        at = seen[slot] = seen.get(slot, -1) + 1
                        for k, v in zip(SCHEMA.names, (part, doc_id, n, width, slot, at, start, length,
                                                       ids[start * width:(start + length) * width])):
                            rows[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in SCHEMA], SCHEMA.names)
    return until_done(run, path)


SCHEMA = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("width", pa.int32()),
                    ("slot", pa.int32()), ("at", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary())])
ITEMS = "part int, doc_id long, n long, width int, slot int, at long, start long, length long, ids binary"
PLAN = ("slot int, lo long, hi long, mult long, seq0 long, off0 long, piece long, base long, stream int")


def pack(docs: DataFrame, capacity: int = CAPACITY, unit: int = UNIT, end_id: int = END_ID,
         tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of all ``docs`` (``doc_id``, ``text``; other columns are ignored), packed.

    Returns per piece ``doc_id, start, length, doc_tokens, sequence_id, offset, width, ids``
    (``ids``: little-endian, ``width`` bytes a token).  ``capacity`` is a power of two and a
    multiple of ``unit``.  A null or empty text is its end id alone; a null id and repeated
    rows are packed like any other row; an empty table gives no piece.
    """
    spark = docs.sparkSession
    ready(spark)
    items = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _items(tokenizer_path or default_path(), end_id, capacity, unit), ITEMS), "pack-items")
    counts = items.groupBy("part", "slot").agg(F.count(F.lit(1)).alias("n"))
    offsets = written(counts.select("part", "slot", "n", F.coalesce(
        F.sum("n").over(Window.partitionBy("slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before")), "pack-offsets")
    # At most capacity / unit + unit classes, however large the corpus.
    total = {r["slot"]: r["n"] for r in offsets.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    rows, seq = [(0, 0, total.get(0, 0), 1, 0, 0, capacity, 0, 0)], total.get(0, 0)
    body, seq, body_end = plan_rows({s: n for s, n in total.items() if 0 < s < TAIL}, unit, capacity, seq, 0)
    tail, seq, tail_end = plan_rows({s - TAIL: n for s, n in total.items() if s > TAIL}, 1, capacity, seq, TAIL)
    plan = F.broadcast(spark.createDataFrame(rows + body + tail, PLAN))
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = (items.join(offsets.select("part", "slot", "before"), ["part", "slot"])
              .withColumn("rank", F.col("before") + F.col("at")).drop("before", "at")
              .join(plan, ["slot"]).where("rank >= lo and rank < hi")
              .withColumn("j", F.expr("rank - lo")))
    stream_at = F.expr("base + j * piece")

    def cuts(end) -> str:
        """Where the partial sequence of a stream is cut, as an SQL array."""
        return "array(" + ", ".join(f"named_struct('a', {a}L, 'b', {b}L, 'seq', {s}L)" for a, b, s in end[1]) + ")"

    def stream(end) -> str:
        whole = (f"transform(sequence(s div {capacity}, (s + piece - 1) div {capacity}), m -> named_struct("
                 f"'a', m * {capacity}, 'b', (m + 1) * {capacity}, 'seq', seq0 + m))")
        if not end[1]:
            return whole
        return f"concat(filter({whole}, c -> c.a < {end[0] * capacity}), {cuts(end)})"

    pieces = placed.withColumn("s", stream_at).withColumn("cut", F.expr(
        f"""explode(case when mult > 0 then array(named_struct('a', s, 'b', s + piece, 'seq', seq0 + j div mult))
            when stream = {TAIL} then {stream(tail_end)} else {stream(body_end)} end)"""))
    pieces = pieces.where("cut.a < s + piece and cut.b > s").select(
        "doc_id", "width", "ids", F.col("n").alias("doc_tokens"),
        F.expr("greatest(cut.a - s, 0)").alias("skip"), F.expr("start + greatest(cut.a - s, 0)").alias("start"),
        F.expr("least(cut.b, s + piece) - greatest(cut.a, s)").alias("length"),
        F.expr("cut.seq").alias("sequence_id"),
        F.expr("case when mult > 0 then off0 + (j % mult) * piece else greatest(s - cut.a, 0) end").alias("offset"))
    return pieces.select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "width",
        F.expr("substring(ids, int(skip * width + 1), int(length * width))").alias("ids"))
