"""Toxicity by a linear-chain conditional random field over the words of each line.

Training labels are per document, so token labels are derived first: over a bounded
sample of labelled documents, a word is a *seed* if it occurs in toxic documents more
often than chance allows (binomial tail, corrected for the number of words tested); seeds in
toxic documents are toxic tokens, all others are not.  A chain with two states is
then fitted by maximum likelihood (forward-backward, adaptive gradient steps) on a bounded
number of lines.  Its features are a word's form, its beginnings and endings, so words
that share a stem with known ones are found too.

Scoring runs forward-backward over every line of every text.  A document's score is a
logistic function of its largest token marginal and of its expected number of toxic
words; runs of tokens with marginal 0.5 or more are the offending spans.
"""

from __future__ import annotations

import math
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import bounded_sample, ready, words_of, written

TOXIC_DOCS, CLEAN_DOCS = 2_000, 8_000
LINES = 2_000  # of each kind: with and without a seed
LINE_WORDS = 400  # longer lines are cut into training lines of at most so many words
DIM = 1 << 15
STEPS = 40
L2 = 0.02
CACHE_WORDS = 500_000
THRESHOLD = 0.3
STRIP = ".,;:!?\"'()[]{}<>|*#$%&-_/"


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: its form, three beginnings and two endings."""
    w = word.strip(STRIP).lower()
    if not w:
        return ()
    kinds = ["w" + w, *(f"p{n}" + w[:n] for n in (4, 5, 6) if len(w) >= n), *(f"s{n}" + w[-n:] for n in (3, 4) if len(w) > n)]
    return tuple(zlib.crc32(k.encode()) % DIM for k in kinds)


def forward_backward(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: float):
    """Log odds of state 1 at each token of many lines, each pass over all lines at once.

    ``e``: log odds of the tokens alone, line after line, longest line first; ``trans``: the
    2 x 2 log potentials.  Returns the forward and backward log odds (their sum is the marginal's).
    """
    at = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    fwd, bwd = np.empty_like(e), np.zeros_like(e)
    (a00, a01), (a10, a11) = trans
    active = len(lengths)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[active - 1] <= t:
            active -= 1
        i = at[:active] + t
        if t == 0:
            fwd[i] = e[i] + start
        else:
            f = fwd[i - 1]
            fwd[i] = e[i] + np.logaddexp(f + a11, a01) - np.logaddexp(f + a10, a00)
    for t in range(int(lengths[0]) - 2 if len(lengths) else -1, -1, -1):
        while active < len(lengths) and lengths[active] > t + 1:
            active += 1
        i = at[:active] + t
        b = e[i + 1] + bwd[i + 1]
        bwd[i] = np.logaddexp(b + a11, a10) - np.logaddexp(b + a01, a00)
    return fwd, bwd


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Chain:
    """Two-state conditional random field: token weights, transitions, and the first token's offset."""

    def __init__(self):
        self.w, self.trans, self.start, self.bias = np.zeros(DIM), np.zeros((2, 2)), 0.0, -6.0
        self.calibration = np.array([-3.0, 0.5, 0.0])

    def emissions(self, words: list[str], seen: dict[str, float]) -> np.ndarray:
        """Log odds of the words alone; ``seen`` holds those of words met before."""
        out = []
        for word in words:
            e = seen.get(word)
            if e is None:
                e = seen[word] = self.bias + float(sum(self.w[f] for f in word_features(word)))
            out.append(e)
        return np.array(out)

    def fit(self, lines: list[tuple[list[tuple[int, ...]], list[int]]], steps: int = STEPS) -> None:
        """Adaptive gradient ascent on the mean log-likelihood of lines of (features, labels); no line changes nothing."""
        if not lines:
            return
        lines = sorted(lines, key=lambda x: (-len(x[0]), x))
        lengths = np.array([len(x[0]) for x in lines])
        tokens = [f for x in lines for f in x[0]]
        y = np.array([v for x in lines for v in x[1]])
        owner = np.repeat(np.arange(len(tokens)), [len(f) for f in tokens])
        feature = np.array([v for f in tokens for v in f], np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        inner = np.ones(len(y), bool)
        inner[begin] = False
        second = np.flatnonzero(inner)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[second - 1], y[second]), 1)
        theta = np.concatenate([self.w, self.trans.ravel(), [self.start, self.bias]])
        squares = np.full(len(theta), 1e-8)
        for _ in range(steps):
            w, trans, start, bias = theta[:DIM], theta[DIM:DIM + 4].reshape(2, 2), theta[-2], theta[-1]
            e = bias + np.bincount(owner, w[feature], len(tokens))
            fwd, bwd = forward_backward(e, lengths, trans, start)
            p = sigmoid(fwd + bwd)
            # Pair marginals: forward odds of t - 1, potentials, and what token t and later ones say.
            f, b = fwd[second - 1], e[second] + bwd[second]
            logs = np.stack([trans[0, 0] + 0 * f, trans[0, 1] + b, trans[1, 0] + f, trans[1, 1] + f + b])
            pair = np.exp(logs - np.logaddexp.reduce(logs, axis=0))
            gap = y - p
            grad = np.concatenate([
                np.bincount(feature, gap[owner], DIM) - L2 * w,
                seen.ravel() - pair.sum(axis=1) - L2 * trans.ravel(), [gap[begin].sum(), gap.sum()]])
            squares += grad ** 2
            theta = theta + 0.7 * grad / np.sqrt(squares)
        self.w, self.trans, self.start, self.bias = theta[:DIM], theta[DIM:DIM + 4].reshape(2, 2), theta[-2], theta[-1]

    def marginals(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """Toxic marginals of each line's tokens (given by their emissions)."""
        order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
        lengths = np.array([len(lines[i]) for i in order], np.int64)
        if not len(lengths) or not lengths[0]:
            return [np.zeros(0) for _ in lines]
        some = int((lengths > 0).sum())
        fwd, bwd = forward_backward(np.concatenate([lines[i] for i in order]), lengths[:some], self.trans, self.start)
        out = [np.zeros(0)] * len(lines)
        for i, p in zip(order, np.split(sigmoid(fwd + bwd), np.cumsum(lengths[:some])[:-1])):
            out[i] = p
        return out

    def document_score(self, top: np.ndarray, expected: np.ndarray) -> np.ndarray:
        a, b, c = self.calibration
        return sigmoid(a + b * np.clip(np.log(top + 1e-9) - np.log1p(1e-9 - top), -10, 10) + c * np.log1p(expected))


def line_words(text: str) -> list[list[str]]:
    """Words of each line that has one."""
    return [w for w in (line.split() for line in text.split("\n")) if w]


def training_lines(text: str) -> list[list[str]]:
    """Words of each line that has one, long lines cut into runs of at most ``LINE_WORDS``."""
    return [w[k:k + LINE_WORDS] for w in line_words(text) for k in range(0, len(w), LINE_WORDS)]


SCORED = "top double, expected double, n_toxic_words long, spans array<struct<start: long, end: long, marginal: double>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))


#: Emissions that this worker has met, by chain; emptied when full.
_SEEN: dict = {}


def _known(chain: Chain) -> dict[str, float]:
    key = (zlib.crc32(chain.w.tobytes()), chain.bias)
    if key not in _SEEN or len(_SEEN[key]) > CACHE_WORDS:
        _SEEN.clear()
        _SEEN[key] = {}
    return _SEEN[key]


def _score(chain: Chain, names: list[str]):
    def spans_of(text: str, marks: list[np.ndarray]) -> list[dict]:
        """Runs of toxic tokens of a line as code point offsets."""
        out, at, k = [], 0, 0
        for line in text.split("\n"):
            words = line.split()
            if words:
                hot, pos, run = marks[k] >= 0.5, 0, None
                k += 1
                for word, is_hot, p in zip(words, hot, marks[k - 1]) if hot.any() else ():
                    a = line.index(word, pos)
                    pos = a + len(word)
                    if is_hot and run:
                        run["end"], run["marginal"] = at + pos, max(run["marginal"], float(p))
                    elif is_hot:
                        out.append(run := {"start": at + a, "end": at + pos, "marginal": float(p)})
                    else:
                        run = None
            at += len(line) + 1
        return out

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(names.index("text")).to_pylist()]
            for at in range(0, len(texts), 1000):
                part, lines, counts, seen = texts[at:at + 1000], [], [], _known(chain)
                for text in part:
                    of = line_words(text)
                    lines += [chain.emissions(words, seen) for words in of]
                    counts.append(len(of))
                marks, k, rows = chain.marginals(lines), 0, []
                for text, n in zip(part, counts):
                    own = marks[k:k + n]
                    k += n
                    top = max((float(m.max()) for m in own), default=0.0)
                    hot = sum(float(m[m >= 0.5].sum()) for m in own)
                    rows.append((top, hot, sum(int((m >= 0.5).sum()) for m in own),
                                 spans_of(text, own) if top >= 0.5 else []))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(at, len(part)) for i in range(len(names)) if names[i] != "text"),
                     pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], pa.int64()), pa.array(cols[3], SPANS)],
                    [*(n for n in names if n != "text"), "top", "expected", "n_toxic_words", "spans"])
    return run


def find_seeds(sample: DataFrame) -> set[str]:
    """All words of toxic sample documents whose document counts chance does not explain; a bounded sample bounds them
    (each takes several toxic documents)."""
    words = sample.select("toxic", F.explode_outer(F.array_distinct(words_of(F.lower("text")))).alias("w")).select(
        "toxic", F.btrim("w", F.lit(STRIP)).alias("w")).where("w <> ''")
    counts = words.groupBy("w").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).where("t >= 2 and 2 * t > n")
    share = sample.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not share["t"] or share["t"] == share["n"]:
        return set()
    p = share["t"] / share["n"]
    # P(Bin(n, p) >= t) <= exp(-n KL(t / n, p)): Chernoff's bound, corrected for the words tested.
    tested = max(1, counts.count())
    q = F.col("t") / F.col("n")
    kl = q * F.log(q / p) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0)
    found = counts.withColumn("x", F.col("n") * kl).where(F.col("x") >= math.log(tested))
    return {r["w"] for r in found.select("w").collect()}


def fit(training: DataFrame, labels: DataFrame | None = None) -> Chain:
    """Chain from texts (``doc_id``, ``text``) and their labels (``doc_id``, ``toxic`` 0 or 1; by default columns of the
    same rows).  Nulls are left out; an id with several labels counts as toxic if one says so.

    At most ``TOXIC_DOCS`` and ``CLEAN_DOCS`` different texts are used, and ``2 * LINES`` of their lines
    reach the driver; a line of more than ``LINE_WORDS`` words counts as several.  Without both kinds of documents the chain scores every text low.
    """
    ready(training.sparkSession)
    chain = Chain()
    labels = training if labels is None else labels
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))
    rows = training.select("doc_id", "text").where("doc_id is not null and text is not null")
    sample = written(bounded_sample(rows, "toxic", {1: TOXIC_DOCS, 0: CLEAN_DOCS}, marks), "toxicity-sample")
    seeds = find_seeds(sample)
    if not seeds:
        return chain

    def pick(batches):
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for words in training_lines(text):
                    y = [int(bool(toxic) and w.lower().strip(STRIP) in seeds) for w in words]
                    line = " ".join(words)
                    out.append((line, y, int(any(y)), zlib.crc32(line.encode())))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.list_(pa.int32())),
                 pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64())], ["line", "y", "kind", "h"])

    lines = written(sample.repartition(int(training.sparkSession.conf.get("spark.sql.shuffle.partitions")))
                    .mapInArrow(pick, "line string, y array<int>, kind int, h long"), "toxicity-lines")
    chosen = []
    for kind in (0, 1):
        chosen += lines.where(f"kind = {kind}").orderBy("h", "line").limit(LINES).select("line", "y").collect()
    features = cache(word_features)  # one tuple a word, not a token
    chain.fit([([features(w) for w in r["line"].split()], list(r["y"])) for r in chosen])
    measured = score_marginals(sample.select("text", F.col("toxic").alias("label")), chain).select(
        "label", "top", "expected").collect()  # two numbers for each document of the sample
    chain.calibration = fit_logistic(np.array([[r["top"], r["expected"]] for r in measured]),
                                     np.array([r["label"] for r in measured]))
    return chain


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Offset and weights of the document score by Newton steps with a small ridge."""
    top = np.clip(np.log(x[:, 0] + 1e-9) - np.log1p(1e-9 - x[:, 0]), -10, 10)
    a = np.stack([np.ones(len(x)), top, np.log1p(x[:, 1])], axis=1)
    beta = np.zeros(3)
    for _ in range(steps):
        p = sigmoid(a @ beta)
        h = a.T @ (a * (p * (1 - p))[:, None]) + 0.1 * np.eye(3)
        beta = beta + np.linalg.solve(h, a.T @ (y - p) - 0.1 * beta)
    return beta


def score_marginals(docs: DataFrame, chain: Chain) -> DataFrame:
    """Every column of ``docs`` but ``text`` with ``top`` (largest marginal), ``expected`` (toxic words expected among
    those of marginal 0.5 or more), ``n_toxic_words`` and ``spans`` (``start, end, marginal``; code points)."""
    from pyspark.sql import types as T

    own = ("top", "expected", "n_toxic_words", "spans")
    names = [c for c in docs.columns if c not in own]
    schema = T.StructType([*(docs.schema[c] for c in names if c != "text"),
                           *T.StructType.fromDDL(SCORED).fields])
    return docs.select(*names).mapInArrow(_score(chain, names), schema)


def score_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id, score, predicted`` with ``n_toxic_words`` and ``spans``, for every row of ``docs``.

    A null or empty text has no token: it gets the score of a text without toxic words, and no
    span.  Other columns are ignored; repeated rows and null ids give rows like any other; an
    empty table gives none.
    """
    ready(docs.sparkSession)
    a, b, c = (float(x) for x in chain.calibration)
    logit = F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.log(F.col("top") + 1e-9) - F.log1p(1e-9 - F.col("top"))))
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * logit + F.lit(c) * F.log1p(F.col("expected")))))
    return score_marginals(docs.select("doc_id", "text"), chain).select(
        "doc_id", score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), "n_toxic_words", "spans")
