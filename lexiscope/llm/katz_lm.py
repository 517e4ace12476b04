"""Katz backoff language model (bigrams), trained and evaluated in partitioned tables.

P(w | h) = d(c) c(h w) / c(h) if the bigram was seen, else alpha(h) P(w); P(w) is the Good-Turing
discounted unigram distribution, its freed mass being one unknown word's.  alpha(h) makes each
history's distribution sum to 1 exactly: (1 - sum of seen discounted) / (1 - sum of their P(w)).
A history without freed mass is scaled by c / (c + 1).

Words are 64-bit hashes; per partition of text numpy counts and sorts them, and what is
shuffled are rows of packed arrays, one for each bucket of keys, not a row for each token.

* Words of at least ``HOT_WORD`` of all training tokens (so at most 1 / ``HOT_WORD`` of them, 16
  bytes each) are broadcast and get small ids; bigrams of at least ``HOT_PAIR`` likewise.  Their
  tokens are settled where the text is read, so no key that is shuffled can hold more than
  that share of the tokens.
* Bigrams lie in the bucket of their history, those of a broadcast history in a bucket of
  their own hash; so a bucket knows its histories whole, or adds its part of a broadcast one's
  sums.  The number of buckets follows the number of tokens.
* log P of a text = sum of log P(w) + log alpha(h) over its tokens, plus, for each seen bigram, log of
  P(w | h) / (alpha(h) P(w)): each term is looked up in one bucket and terms are summed per text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import ready, written
from lexiscope.llm.word_hash import U, mix, pair_hash, text_chunks
from lexiscope.session import scratch_path

K = 5  # counts up to this are discounted
HOT_WORD = 1e-6
HOT_PAIR = 1e-6
BUCKET_TOKENS = 4_000_000
HOLD = 1_500_000  # tokens that a task gathers before it sends them on
BOS, END = 0, 1  # ids; those of broadcast words follow
END_HASH = U(0x0123456789ABCDEF)
RARE = U(1 << 63)
ID_BITS = U(24)

UNI, HH, XX, HIST = 0, 1, 2, 3  # table rows: words; bigrams of two ids; other bigrams; sums of a broadcast history
Q_WORD, Q_HH, Q_XX, Q_COLD, DIRECT = 10, 11, 12, 13, 14  # what texts ask, and what they know already

ROW = "bucket int, kind int, chunk long, a binary, b binary, c binary, d binary"
ROW_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int64()),
                        *((c, pa.binary()) for c in "abcd")])


def pack(x: np.ndarray, ordered: bool = False) -> bytes:
    """Byte planes of an array (of its differences if it is ordered), compressed."""
    if ordered and len(x):
        x = np.diff(x, prepend=x.dtype.type(0))
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes, dtype, ordered: bool = False) -> np.ndarray:
    dtype = np.dtype(dtype)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    x = np.ascontiguousarray(flat.reshape(dtype.itemsize, -1).T).view(dtype).ravel()
    return np.cumsum(x, dtype=dtype) if ordered else x


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(ROW_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ROW_SCHEMA)], ROW_SCHEMA.names)


def total_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def cut(bucket: np.ndarray, *arrays):
    """``(bucket, arrays)`` of each bucket that occurs, keeping the order within it."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for a, b in zip(first, [*first[1:], len(bucket)]):
        yield int(bucket[a]), [x[order[a:b]] for x in arrays]


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in an ordered table; -1 for those that aren't in it."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class Hashes:
    """Places of uniformly distributed keys, by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, len(keys).bit_length() + 1)
        self.shift = U(64 - bits)
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=U) << self.shift)

    def find(self, q: np.ndarray) -> np.ndarray:
        out = np.full(len(q), -1)
        if not len(self.keys):
            return out
        todo, at = np.arange(len(q)), self.first[q >> self.shift]
        while len(todo):
            live = at < len(self.keys)
            todo, at = todo[live], at[live]
            key, want = self.keys[at], q[todo]
            same = key == want
            out[todo[same]] = at[same]
            later = key < want
            todo, at = todo[later], at[later] + 1
        return out


def discounts(n: list[int], k: int = K) -> np.ndarray:
    """Katz's factors d(0..k) from n = [n1, ..., n(k+1)]; 1 where Good-Turing gives none."""
    d = np.ones(k + 1)
    if n[0] and n[k] and (common := (k + 1) * n[k] / n[0]) < 1:
        for r in range(1, k + 1):
            if n[r - 1]:
                x = ((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common)
                d[r] = x if 0 < x <= 1 else 1.0
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return c * np.where(c <= K, d[np.minimum(c, K).astype(np.int64)], 1.0)


@dataclass
class Model:
    """What every task needs to know; the rest lies in ``table`` (bucketed)."""
    n: int  # training tokens
    v: int  # distinct ones
    docs: int
    buckets: int
    d1: np.ndarray
    unknown: float  # probability of the unknown word
    scale1: float
    hot: np.ndarray  # hashes of the broadcast words, in order
    counts: np.ndarray  # by id: as a token; BOS's is that of training texts
    d2: np.ndarray = field(default_factory=lambda: np.ones(K + 1))
    alpha: np.ndarray | None = None  # by id: log10 of alpha and of the history's scale
    scale: np.ndarray | None = None
    pairs: np.ndarray | None = None
    gain: np.ndarray | None = None
    table: str = ""

    def p1(self, c: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(c))
        return np.where(c > 0, discounted(c, self.d1) / self.n * self.scale1, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))

    def weight(self, total: np.ndarray, mass: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of alpha and of the scale of histories from their counts, discounted sums and sums of P(w)."""
        free = 1 - mass / np.maximum(total, 1)
        none = free <= 1e-12
        scale = np.where(none, total / (total + 1), 1.0)
        free = np.where(none, 1 / (total + 1), free)
        alpha = np.log10(free / np.maximum(1 - lower, self.unknown))
        return np.where(total > 0, alpha, 0.0), np.log10(np.maximum(scale, 1e-300))

    def bucket(self, prev: np.ndarray, key: np.ndarray) -> np.ndarray:
        return (np.where(prev < RARE, mix(key), mix(prev)) % U(self.buckets)).astype(np.int64)


class Coder:
    """Words as ids where they are broadcast, else as hashes with the top bit set."""

    def __init__(self, model: Model):
        self.index = Hashes(model.hot)

    def codes(self, words: np.ndarray) -> np.ndarray:
        at = self.index.find(words)
        return np.where(at >= 0, at.astype(U) + U(2), words | RARE)


def bigrams(codes: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """History, word and text of every token (the end of each text included)."""
    n = len(where) - 1
    text = np.repeat(np.arange(n), np.diff(where) + 1)
    cur, prev = np.empty(len(text), U), np.empty(len(text), U)
    at = np.arange(len(codes)) + np.repeat(np.arange(n), np.diff(where))
    cur[at], prev[at + 1] = codes, codes
    cur[where[1:] + np.arange(n)] = END
    prev[where[:-1] + np.arange(n)] = BOS
    return prev, cur, text


def pair_keys(prev: np.ndarray, cur: np.ndarray) -> np.ndarray:
    """Exact keys below 2^48 for two ids, else hashes with the top bit set."""
    return np.where((prev < RARE) & (cur < RARE), (prev << ID_BITS) | cur, pair_hash(prev, cur) | RARE)


def _train_chunks(batches):
    for batch in batches:
        train = np.asarray(batch.column("train").to_numpy(zero_copy_only=False), bool)
        if train.any():
            yield from (x[2:] for x in text_chunks(batch.column("text").filter(pa.array(train))))


def _count_words(buckets: int):
    def run(batches):
        keys, counts, held = [], [], 0

        def send():
            k, c = total_by(np.concatenate(keys), np.concatenate(counts))
            return batch_of([(b, UNI, 0, pack(x, True), pack(y), None, None)
                             for b, (x, y) in cut((k % U(buckets)).astype(np.int64), k, c)])

        for words, where in _train_chunks(batches):
            k, c = np.unique(words, return_counts=True)
            keys += [k, np.array([END_HASH])]
            counts += [c.astype(np.int64), np.array([len(where) - 1])]
            held += len(k)
            if held > 2 * HOLD:
                yield send()
                keys, counts, held = [], [], 0
        if keys:
            yield send()
    return run


def _add_words(table: pa.Table) -> pa.Table:
    k, c = total_by(np.concatenate([unpack(x, U, True) for x in table.column("a").to_pylist()]),
                    np.concatenate([unpack(x, np.int64) for x in table.column("b").to_pylist()]))
    stats = np.concatenate([[c.sum(), len(c)], np.bincount(np.minimum(c, K + 2), minlength=K + 3)[1:K + 2]])
    rows = [(table.column("bucket")[0].as_py(), UNI, 0, pack(k, True), pack(c), stats.astype(np.int64).tobytes(), None)]
    return pa.Table.from_batches([batch_of(rows)])


def _hot_words(least: int):
    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                k, c = unpack(a, U, True), unpack(b, np.int64)
                use = c >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[use].tobytes()]), pa.array([c[use].tobytes()])], ["k", "c"])
    return run


def _deal_words(model_of):
    """Word counts by the model's buckets; broadcast words are left out."""
    def run(batches):
        model = model_of.value
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                k, c = unpack(a, U, True), unpack(b, np.int64)
                use = find(model.hot, k) < 0
                k, c = k[use] | RARE, c[use]
                k, c = total_by(k, c)
                yield batch_of([(i, UNI, 0, pack(x, True), pack(y), None, None)
                                for i, (x, y) in cut(model.bucket(k, k), k, c)])
    return run


def _count_pairs(model_of, rare: bool):
    """Bigram counts of the training texts: those of a rare word (to its bucket, for its count), or the others."""
    def run(batches):
        model = model_of.value
        coder, hold, held = Coder(model), [], 0

        def send():
            prev, cur = (np.concatenate(x) for x in zip(*hold))
            key = pair_keys(prev, cur)
            key, first, count = np.unique(key, return_index=True, return_counts=True)
            prev, cur, count = prev[first], cur[first], count.astype(np.int64)
            if rare:
                return batch_of([(b, XX, 0, pack(k, True), pack(c), pack(p), pack(w)) for b, (k, c, p, w) in
                                 cut(model.bucket(cur, cur), key, count, prev, cur)])
            both = key < RARE
            where = model.bucket(prev, key)
            rows = [(b, HH, 0, pack(k, True), pack(c), None, None)
                    for b, (k, c) in cut(where[both], key[both], count[both])]
            one = ~both
            c2 = model.counts[cur[one].astype(np.int64)].astype(np.int64)
            return batch_of(rows + [(b, XX, 0, pack(k, True), pack(c), pack(p), pack(w)) for b, (k, c, p, w) in
                                    cut(where[one], key[one], count[one], prev[one], c2)])

        for words, where in _train_chunks(batches):
            prev, cur, _ = bigrams(coder.codes(words), where)
            use = (cur >= RARE) == rare
            hold.append((prev[use], cur[use]))
            held += int(use.sum())
            if held > HOLD:
                yield send()
                hold, held = [], 0
        if held:
            yield send()
    return run


def _with_counts(model_of):
    """A bucket of words and the bigrams that end in them: the bigrams with the word's count, to their own bucket."""
    def group(table: pa.Table) -> pa.Table:
        model, rows = model_of.value, table.to_pylist()
        words = [(unpack(r["a"], U, True), unpack(r["b"], np.int64)) for r in rows if r["kind"] == UNI]
        k, c = total_by(np.concatenate([x for x, _ in words] or [np.zeros(0, U)]),
                        np.concatenate([y for _, y in words] or [np.zeros(0, np.int64)]))
        got = [(unpack(r["a"], U, True), unpack(r["b"], np.int64), unpack(r["c"], U), unpack(r["d"], U))
               for r in rows if r["kind"] == XX]
        out = []
        if got:  # all of a bucket at once: one row for each bucket they go to
            key, count, prev, cur = (np.concatenate(x) for x in zip(*got))
            order = np.argsort(key, kind="stable")
            key, count, prev, cur = key[order], count[order], prev[order], cur[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, count, prev, cur = key[first], np.add.reduceat(count, first), prev[first], cur[first]
            out = [(b, XX, 0, pack(x, True), pack(y), pack(p), pack(w)) for b, (x, y, p, w) in
                   cut(model.bucket(prev, key), key, count, prev, c[find(k, cur)])]
        return pa.Table.from_batches([batch_of(out)])
    return group


def xx_of(rows) -> tuple[np.ndarray, ...]:
    """Other bigrams of table rows, added up: key, count, history, count of the word."""
    got = [(unpack(r["a"], U, True), unpack(r["b"], np.int64), unpack(r["c"], U), unpack(r["d"], np.int64))
           for r in rows if r["kind"] == XX]
    if not sum(len(x[0]) for x in got):
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    key, count, prev, c2 = (np.concatenate(x) for x in zip(*got))
    order = np.argsort(key, kind="stable")
    key, count, prev, c2 = key[order], count[order], prev[order], c2[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count, first), prev[first], c2[first]


def hh_of(rows) -> tuple[np.ndarray, np.ndarray]:
    got = [(unpack(r["a"], U, True), unpack(r["b"], np.int64)) for r in rows if r["kind"] == HH]
    return total_by(np.concatenate([x for x, _ in got] or [np.zeros(0, U)]),
                    np.concatenate([y for _, y in got] or [np.zeros(0, np.int64)]))


def history_sums(model: Model, prev: np.ndarray, count: np.ndarray, c2: np.ndarray):
    """Distinct histories, and of each: how many words follow 1..K times, tokens of those that follow more
    often, the sum of P(w), and all tokens."""
    order = np.argsort(prev, kind="stable")
    prev, count, c2 = prev[order], count[order], c2[order]
    if not len(prev):
        return prev, np.zeros((0, K)), np.zeros(0), np.zeros(0), np.zeros(0)
    first = np.flatnonzero(np.concatenate([[True], prev[1:] != prev[:-1]]))
    times = np.stack([np.add.reduceat((count == r).astype(float), first) for r in range(1, K + 1)], axis=1)
    return (prev[first], times, np.add.reduceat(np.where(count > K, count, 0).astype(float), first),
            np.add.reduceat(model.p1(c2), first), np.add.reduceat(count.astype(float), first))


def _add_pairs(model_of):
    def group(table: pa.Table) -> pa.Table:
        model, rows = model_of.value, table.to_pylist()
        bucket = rows[0]["bucket"]
        key, count = hh_of(rows)
        xkey, xcount, xprev, xc2 = xx_of(rows)
        c = np.concatenate([count, xcount])
        nr = np.bincount(np.minimum(c, K + 2), minlength=K + 3)[1:K + 2].astype(np.int64)
        warm = xprev < RARE
        ids, times, more, lower, _ = history_sums(
            model, np.concatenate([key >> ID_BITS, xprev[warm]]), np.concatenate([count, xcount[warm]]),
            np.concatenate([model.counts[(key & U((1 << 24) - 1)).astype(np.int64)], xc2[warm]]))
        out = [(bucket, HH, 0, pack(key, True), pack(count), None, None),
               (bucket, XX, 0, pack(xkey, True), pack(xcount), pack(xprev), pack(xc2)),
               (bucket, HIST, 0, pack(ids, True), pack(np.column_stack([times, more, lower]).ravel()), nr.tobytes(), None)]
        return pa.Table.from_batches([batch_of(out)])
    return group


def _deal_histories(buckets: int):
    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                ids, x = unpack(a, U, True), unpack(b, np.float64).reshape(-1, K + 2)
                yield batch_of([(i, HIST, 0, pack(k, True), pack(y.ravel()), None, None)
                                for i, (k, y) in cut((ids % U(buckets)).astype(np.int64), ids, x)])
    return run


def _weigh_histories(model: Model):
    counts, d2 = model.counts, model.d2

    def group(table: pa.Table) -> pa.Table:
        got = [(unpack(a, U, True), unpack(b, np.float64).reshape(-1, K + 2))
               for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist())]
        ids, x = np.concatenate([k for k, _ in got]), np.concatenate([y for _, y in got])
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
        ids, x = ids[first], np.add.reduceat(x, first, axis=0) if len(first) else x
        mass = x[:, :K] @ (d2[1:] * np.arange(1, K + 1)) + x[:, K]
        alpha, scale = model.weight(counts[ids.astype(np.int64)].astype(float), mass, x[:, K + 1])
        return pa.table({"ids": [ids.tobytes()], "alpha": [alpha.tobytes()], "scale": [scale.tobytes()]})
    return group


def _hot_pairs(least: int):
    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                k, c = unpack(a, U, True), unpack(b, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[c >= least].tobytes()]), pa.array([c[c >= least].tobytes()])], ["k", "c"])
    return run


def gain_of_ids(model: Model, key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """log10 of P(w | h) / (alpha(h) P(w)) of seen bigrams of two ids."""
    h, w = (key >> ID_BITS).astype(np.int64), (key & U((1 << 24) - 1)).astype(np.int64)
    return (np.log10(discounted(count, model.d2) / model.counts[h]) + model.scale[h]
            - model.alpha[h] - np.log10(model.p1(model.counts[w])))


def gathered(df: DataFrame, *names: str) -> list[np.ndarray]:
    """Arrays of a bounded table's rows, joined."""
    rows = df.collect()
    return [np.concatenate([np.frombuffer(r[n], t) for r in rows] or [np.zeros(0, t)])
            for n, t in ((x.split(":")[0], x.split(":")[1]) for x in names)]


def train(docs: DataFrame, train_col: str = "train", hot_word: float = HOT_WORD, hot_pair: float = HOT_PAIR,
          bucket_tokens: int = BUCKET_TOKENS) -> Model:
    """Model of the texts whose ``train_col`` is true (``text`` and that column are read)."""
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select("text", F.coalesce(F.col(train_col), F.lit(False)).alias("train"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = written(rows.mapInArrow(_count_words(parts), ROW).groupBy("bucket").applyInArrow(_add_words, ROW),
                    "katz-words")
    stats = [np.frombuffer(r["c"], np.int64) for r in words.select("c").collect()]  # K + 3 numbers a bucket
    total = np.sum(stats, axis=0) if stats else np.zeros(K + 3, np.int64)
    n, v = int(total[0]), int(total[1])
    least = max(1, int(np.ceil(hot_word * n)))
    keys, counts = gathered(words.mapInArrow(_hot_words(least), "k binary, c binary"), "k:uint64", "c:int64")
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    is_end = keys == END_HASH
    n_docs = int(counts[is_end].sum())
    if not is_end.any() and n:
        n_docs = int(gathered(words.mapInArrow(_of_key(END_HASH), "c binary"), "c:int64")[0].sum())
    keys, counts = keys[~is_end], counts[~is_end]
    d1 = discounts(total[2:].tolist())
    mass = (n - sum((1 - d1[r]) * r * int(total[1 + r]) for r in range(1, K + 1))) / max(n, 1)
    scale1 = n / (n + 1) if mass >= 1 - 1e-12 else 1.0
    model = Model(n=n, v=v, docs=n_docs, buckets=max(parts, -(-n // bucket_tokens)), d1=d1,
                  unknown=1 - mass * scale1, scale1=scale1, hot=keys,
                  counts=np.concatenate([[n_docs, n_docs], counts]).astype(np.int64))
    shared = spark.sparkContext.broadcast(model)
    dealt = words.mapInArrow(_deal_words(shared), ROW)
    of_rare = (dealt.union(rows.mapInArrow(_count_pairs(shared, True), ROW)).repartition(model.buckets, "bucket")
               .groupBy("bucket").applyInArrow(_with_counts(shared), ROW))
    pairs = (of_rare.union(rows.mapInArrow(_count_pairs(shared, False), ROW)).repartition(model.buckets, "bucket")
             .groupBy("bucket").applyInArrow(_add_pairs(shared), ROW))
    model.table = "katz_" + uuid.uuid4().hex
    (pairs.union(dealt).repartition(model.buckets, "bucket").write.bucketBy(model.buckets, "bucket")
     .option("path", scratch_path(spark, "katz-table")).saveAsTable(model.table))
    table = spark.table(model.table)
    nr = [np.frombuffer(r["c"], np.int64) for r in table.where(f"kind = {HIST}").select("c").collect()]
    model.d2 = discounts((np.sum(nr, axis=0) if nr else np.zeros(K + 1, np.int64)).tolist())
    weighed = (table.where(f"kind = {HIST}").mapInArrow(_deal_histories(parts), ROW).groupBy("bucket")
               .applyInArrow(_weigh_histories(model), "ids binary, alpha binary, scale binary"))
    ids, alpha, scale = gathered(weighed, "ids:uint64", "alpha:float64", "scale:float64")
    model.alpha, model.scale = np.zeros(len(model.counts)), np.zeros(len(model.counts))
    model.alpha[ids.astype(np.int64)], model.scale[ids.astype(np.int64)] = alpha, scale
    least = max(1, int(np.ceil(hot_pair * n)))
    keys, counts = gathered(table.where(f"kind = {HH}").mapInArrow(_hot_pairs(least), "k binary, c binary"),
                            "k:uint64", "c:int64")
    order = np.argsort(keys)
    model.pairs = keys[order]
    model.gain = gain_of_ids(model, keys[order], counts[order])
    shared.unpersist()
    return model


def _of_key(key):
    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                use = unpack(a, U, True) == key
                yield pa.RecordBatch.from_arrays([pa.array([unpack(b, np.int64)[use].tobytes()])], ["c"])
    return run


def _ask(model_of):
    """What texts can't settle themselves, by bucket; and, as one row of a chunk, what they can."""
    def run(batches):
        model = model_of.value
        coder, part, chunk = Coder(model), TaskContext.get().partitionId(), 0
        alpha, p1, base = model.alpha, np.log10(model.p1(model.counts)), model.base(model.counts)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            held = batch.column("held_out").to_pylist()
            for i, j, words, where in text_chunks(batch.column("text")):
                prev, cur, text = bigrams(coder.codes(words), where)
                n, at = j - i, (part << 32) | chunk
                chunk += 1
                text = text.astype(np.uint32)
                known, warm = cur < RARE, prev < RARE
                sums = np.zeros((3, n))  # known tokens, base score, score
                w = cur[known].astype(np.int64)
                sums[0] = np.bincount(text[known], model.counts[w] > 0, n)
                sums[1] = np.bincount(text[known], base[w], n)
                sums[2] = np.bincount(text[known], p1[w], n) + np.bincount(
                    text[warm], alpha[prev[warm].astype(np.int64)], n)
                key = pair_keys(prev, cur)
                order = np.argsort(key, kind="stable")
                key, prev, cur, text = key[order], prev[order], cur[order], text[order]
                hot = find(model.pairs, key)
                sums[2] += np.bincount(text[hot >= 0], model.gain[hot[hot >= 0]], n)
                rest = hot < 0
                bucket = model.bucket(prev, key)
                rows = []
                for kind, use in ((Q_HH, rest & (key < RARE)), (Q_XX, rest & (key >= RARE) & (prev < RARE))):
                    rows += [(b, kind, at, pack(k, True), pack(t), None, None)
                             for b, (k, t) in cut(bucket[use], key[use], text[use])]
                use = prev >= RARE
                rows += [(b, Q_COLD, at, pack(k, True), pack(t), pack(p), None)
                         for b, (k, t, p) in cut(bucket[use], key[use], text[use], prev[use])]
                use = cur >= RARE
                order = np.argsort(cur[use], kind="stable")
                c, t = cur[use][order], text[use][order]
                rows += [(b, Q_WORD, at, pack(k, True), pack(x), None, None)
                         for b, (k, x) in cut(model.bucket(c, c), c, t)]
                note = pa.RecordBatch.from_arrays(
                    [pa.array(ids[i:j], pa.int64()), pa.array(held[i:j], pa.bool_()),
                     pa.array(np.diff(where) + 1)], ["doc_id", "held_out", "n_tokens"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, note.schema) as out:
                    out.write_batch(note)
                rows.append((at % model.buckets, DIRECT, at, pack(sums.ravel()), sink.getvalue().to_pybytes(), None, None))
                yield batch_of(rows)
    return run


def _answer(model_of):
    """A bucket of the table and what texts ask of it: per chunk the texts' sums."""
    def group(table: pa.Table, asked: pa.Table) -> pa.Table:
        model, rows, questions = model_of.value, table.to_pylist(), asked.to_pylist()
        words = [(unpack(r["a"], U, True), unpack(r["b"], np.int64)) for r in rows if r["kind"] == UNI]
        wkey, wcount = total_by(np.concatenate([x for x, _ in words] or [np.zeros(0, U)]),
                                np.concatenate([y for _, y in words] or [np.zeros(0, np.int64)]))
        key, count = hh_of(rows)
        gain = gain_of_ids(model, key, count)
        xkey, xcount, xprev, xc2 = xx_of(rows)
        cold = xprev >= RARE
        hist, times, more, lower, total = history_sums(model, xprev[cold], xcount[cold], xc2[cold])
        mass = times @ (model.d2[1:] * np.arange(1, K + 1)) + more
        alpha, scale = model.weight(total, mass, lower)
        # Of each other bigram: its history's alpha, scale and count.
        a, s, t = np.empty(len(xkey)), np.empty(len(xkey)), np.empty(len(xkey))
        at = find(hist, xprev[cold])
        a[cold], s[cold], t[cold] = alpha[at], scale[at], total[at]
        ids = xprev[~cold].astype(np.int64)
        a[~cold], s[~cold], t[~cold] = model.alpha[ids], model.scale[ids], model.counts[ids]
        xgain = np.log10(discounted(xcount, model.d2) / np.maximum(t, 1)) + s - a - np.log10(model.p1(xc2))
        out, chunks = [], {}
        for q in questions:
            if q["kind"] == DIRECT:
                out.append((q["bucket"], DIRECT, q["chunk"], q["a"], q["b"], None, None))
            else:
                chunks.setdefault(q["chunk"], []).append(q)
        for chunk, of in chunks.items():
            parts = [], []
            for q in of:
                k, text = unpack(q["a"], U, True), unpack(q["b"], np.uint32)
                add = np.zeros((3, len(k)))
                if q["kind"] == Q_WORD:
                    at = find(wkey, k)
                    c = np.where(at >= 0, wcount[at] if len(wcount) else 0, 0)
                    add[0], add[1], add[2] = c > 0, model.base(c), np.log10(model.p1(c))
                else:
                    value, where = (gain, find(key, k)) if q["kind"] == Q_HH else (xgain, find(xkey, k))
                    seen = where >= 0
                    add[2, seen] = value[where[seen]]
                    if q["kind"] == Q_COLD:
                        at = find(hist, unpack(q["c"], U))
                        add[2, at >= 0] += alpha[at[at >= 0]]
                parts[0].append(text)
                parts[1].append(add)
            text, back = np.unique(np.concatenate(parts[0]), return_inverse=True)
            add = np.concatenate(parts[1], axis=1)
            sums = np.stack([np.bincount(back, x, len(text)) for x in add])
            out.append((of[0]["bucket"], Q_WORD, chunk, pack(text, True), pack(sums[0].astype(np.uint32)),
                        pack(sums[1]), pack(sums[2])))
        return pa.Table.from_batches([batch_of(out)])
    return group


def _settle(train_tokens: int):
    def group(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        first = next(r for r in rows if r["kind"] == DIRECT)
        with pa.ipc.open_stream(first["b"]) as got:
            note = got.read_all()
        sums = unpack(first["a"], np.float64).reshape(3, -1).copy()
        # Sums of floats depend on their order: rows are added by bucket.
        for r in sorted((r for r in rows if r["kind"] != DIRECT), key=lambda r: r["bucket"]):
            text = unpack(r["a"], np.uint32, True)
            sums[:, text] += [unpack(r["b"], np.uint32), unpack(r["c"], np.float64), unpack(r["d"], np.float64)]
        n = note.num_rows
        return pa.table({
            "doc_id": note["doc_id"], "held_out": note["held_out"], "n_tokens": note["n_tokens"].cast(pa.int64()),
            "n_known": pa.array(sums[0].round().astype(np.int64)),
            "train_tokens": pa.array(np.full(n, train_tokens, np.int64)),
            "base_score": pa.array(sums[1]), "score": pa.array(sums[2])})
    return group


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """log10 probabilities of every row of ``docs`` (``doc_id``, ``text``, ``held_out``): ``doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score`` (add-one unigrams), ``score``.

    A null text counts as empty (its end alone); a null id stays null; rows that repeat an
    id are scored one by one; other columns are ignored; an empty table gives no row.  With an
    empty training set every token has probability 1 under the model.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("held_out"), F.col("text"))
    asked = rows.mapInArrow(_ask(shared), ROW)
    answers = spark.table(model.table).where(f"kind <> {HIST}").groupBy("bucket").cogroup(
        asked.groupBy("bucket")).applyInArrow(_answer(shared), ROW)
    answers = written(answers, "katz-answers")
    return answers.groupBy("chunk").applyInArrow(_settle(model.n), SCORED)


def score_documents(docs: DataFrame, held_out, **settings) -> DataFrame:
    """``score`` of all rows by a model of those for which the condition ``held_out`` is false (a null
    condition: not learned from, not held out)."""
    marked = docs.select("doc_id", "text", held_out.alias("h")).select(
        "doc_id", "text", F.coalesce("h", F.lit(False)).alias("held_out"), (~F.col("h")).alias("train"))
    return score(marked, train(marked, **settings))

