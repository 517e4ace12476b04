"""Word tables that are looked up row by row, without a join.

A small one stands as literals in the plan: perfect hashing by displacement.  Words fall into buckets by their hash; each
bucket has a displacement that sends its words to free slots of one table (buckets with most words choose first).  A lookup is
one hash and two array reads, whatever the number of words.

Literals cost the driver several hundred bytes a word (Python rows, then boxed words in the plan, in its text and in each
task).  A large table is therefore packed (:func:`packed`): words sorted by hash, as one Arrow buffer that workers get by
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PER_BUCKET, SPARE = 4, 1.25
LOW31 = (1 << 31) - 1
MOST_TRIES = 1 << 20


@dataclass(frozen=True)
class WordTable:
    """``displacement`` of each bucket, ``words`` and ``codes`` of each slot; ``rest`` holds words whose hashes
    cannot be parted."""
    displacement: list[int]
    words: list[str]
    codes: list[int]
    rest: dict[str, int]


def _slot(h: int, d: int, n: int) -> int:
    return ((h & LOW31) + d * ((h >> 32 & LOW31) | 1)) % n


def build(rows: list[tuple[str, int, int]]) -> WordTable:
    """The table of ``(word, code, hash)`` rows (``xxhash64`` of the word, as a signed or unsigned integer)."""
    n, n_buckets = int(len(rows) * SPARE) + 3 | 1, max(1, len(rows) // PER_BUCKET)
    buckets: list[list[tuple[str, int, int]]] = [[] for _ in range(n_buckets)]
    for word, code, h in rows:
        buckets[(h >> 8 & LOW31) % n_buckets].append((word, code, h & (1 << 64) - 1))
    displacement, words, codes, rest = [0] * n_buckets, [""] * n, [0] * n, {}
    taken = bytearray(n)
    for b in sorted(range(n_buckets), key=lambda b: -len(buckets[b])):
        bucket = buckets[b]
        for d in range(MOST_TRIES if len({h for _, _, h in bucket}) == len(bucket) else 0):
            slots = [_slot(h, d, n) for _, _, h in bucket]
            if not any(taken[s] for s in slots) and len(set(slots)) == len(slots):
                displacement[b] = d
                for s, (word, code, _) in zip(slots, bucket):
                    taken[s], words[s], codes[s] = 1, word, code
                break
        else:
            rest |= {word: code for word, code, _ in bucket}
    return WordTable(displacement, words, codes, rest)


def collect(lookup: DataFrame) -> WordTable:
    """The table of ``lookup`` (``word``, ``code``), which must be of a checked size."""
    rows = lookup.select("word", "code", F.xxhash64("word").alias("h")).collect()
    return build([(r["word"], r["code"], r["h"]) for r in rows])


def _literal(values: list, kind: str) -> Column:
    """A constant array; words hold no white space."""
    return F.split(F.lit("\n".join(map(str, values))), "\n").cast(f"array<{kind}>")


def codes_of(tokens: Column, table: WordTable) -> Column:
    """``ARRAY<STRUCT<t, code>>``: the code of each token that is in the table, null for others."""
    n, n_buckets = len(table.words), len(table.displacement)
    displacement, words, codes = (_literal(x, k) for x, k in (
        (table.displacement, "int"), (table.words, "string"), (table.codes, "int")))
    hashed = F.transform(tokens, lambda t: F.struct(t.alias("t"), F.xxhash64(t).alias("h")))

    def place(x: Column) -> Column:
        h = x["h"]
        bucket = (F.shiftrightunsigned(h, 8).bitwiseAND(LOW31) % n_buckets).cast("int")
        step = F.shiftrightunsigned(h, 32).bitwiseAND(LOW31).bitwiseOR(F.lit(1).cast("long"))
        slot = ((h.bitwiseAND(LOW31) + F.get(displacement, bucket) * step) % n).cast("int")
        return F.struct(x["t"].alias("t"), slot.alias("s"))

    def code(x: Column) -> Column:
        found = F.when((F.get(words, x["s"]) == x["t"]) & (x["t"] != ""), F.get(codes, x["s"]))  # free slots are empty
        for word, c in sorted(table.rest.items()):
            found = F.when(x["t"] == word, c).otherwise(found)
        return F.struct(x["t"].alias("t"), found.alias("code"))

    return F.transform(F.transform(hashed, place), code)


# ---- a large table: sorted by hash, broadcast to the Python workers -------------


def packed(lookup: DataFrame) -> pa.Table:
    """``word, code, h`` of ``lookup`` sorted by ``h`` (``xxhash64`` of the word); its size must be checked."""
    rows = lookup.where(F.col("word").isNotNull()).select("word", F.col("code").cast("byte"), F.xxhash64("word").alias("h"))
    return rows.sort("h").toArrow().combine_chunks()


def most_of_one_hash(h: np.ndarray) -> int:
    """The largest number of words with the same hash, in a sorted column."""
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return int(np.diff(np.r_[starts, len(h)]).max()) if len(h) else 0


def find_codes(words: pa.Array, codes: np.ndarray, h: np.ndarray, most: int, tokens: pa.Array, hashes: np.ndarray,
               default: int) -> np.ndarray:
    """The code of each token, ``default`` for one that is not in the table (``words``, ``codes``, sorted ``h``)."""
    out = np.full(len(tokens), default, "int32")
    first = np.searchsorted(h, hashes)
    for k in range(most):
        at = np.minimum(first + k, len(h) - 1)
        like = np.flatnonzero(h[at] == hashes)
        same = pc.equal(words.take(pa.array(at[like])), tokens.take(pa.array(like))).to_numpy(zero_copy_only=False)
        out[like[same]] = codes[at[like[same]]]
    return out


def packed_codes(spark: SparkSession, table: pa.Table, default: int, drop: int) -> Callable[[Column], Column]:
    """``ARRAY<INT>`` of the codes of a column of words (none for a null): ``default`` for words that are not in the
    :func:`packed` table; those of the code ``drop`` are left out."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    most = most_of_one_hash(table["h"].to_numpy())
    shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())

    @F.arrow_udf("array<int>")
    def codes_of_words(rows: pa.Array) -> pa.Array:
        held = pa.ipc.open_stream(shared.value).read_all()  # views of the broadcast, nothing is copied
        words, codes, h = (c.chunk(0) if c.num_chunks == 1 else c.combine_chunks() for c in held.columns)
        found = rows.flatten()
        tokens = found.field("t")
        if words.type != tokens.type:
            words = words.cast(tokens.type)
        values = find_codes(words, codes.to_numpy(), h.to_numpy(), most, tokens, found.field("h").to_numpy(), default)
        kept = values != drop
        ends = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy())]
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(kept)][ends], pa.int32()), pa.array(values[kept]))

    return lambda words: codes_of_words(F.transform(words, lambda t: F.struct(t.alias("t"), F.xxhash64(t).alias("h"))))
