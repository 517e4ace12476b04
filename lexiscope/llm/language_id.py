"""Language identification by hierarchical discrimination.

A text becomes a vector of hashed character n-grams (1 to 3 letters of its lower-cased
letters, words set apart by one space; square roots of counts, length 1).  First the
language family is decided, then, within it, one-versus-one linear support vector
machines tell its languages apart.  Both levels are fitted on at most ``SAMPLE`` different
texts of each language; features are made and texts are scored on the executors.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import bounded_sample, ready
from lexiscope.llm.word_hash import U, mix

DIM = 4096
SAMPLE = 300
EPOCHS = 30
COST = 4.0
UNKNOWN = "und"
#: Below this score the pipeline rejects a document.
MIN_SCORE = 0.2

#: Families of common languages (fixed values); any other language is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca"],
    "slavic": ["ru", "uk", "pl", "cs", "bg", "sr"],
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


_LETTER = None


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, every other run as one space (at both ends too)."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.concatenate([[32], np.where(_LETTER[x], x, 32), [32]]).astype(U)
    return x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]


def features(text: str) -> np.ndarray | None:
    """Unit vector of a text; None without a letter."""
    x = letters(text)
    if len(x) < 2:
        return None
    v = np.zeros(DIM, np.float32)
    code = np.zeros(len(x), U)
    for n in range(1, 4):
        if len(x) < n:
            break
        code = (code[:len(x) - n + 1] * U(1 << 21) + x[n - 1:]) if n > 1 else x
        v += np.bincount((mix(code + U(n << 60)) >> U(52)).astype(np.int64), minlength=DIM)
    v = np.sqrt(v)
    return v / np.linalg.norm(v)


def fit_pair(x: np.ndarray, y: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Linear support vector machine (squared hinge, dual coordinate descent); y is -1 or 1; the last
    weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diag = 1 / (2 * cost)
    norm = (x.astype(float) ** 2).sum(axis=1) + diag
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + diag * alpha[i]
            new = max(alpha[i] - g / norm[i], 0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


class PairVote:
    """One-versus-one machines over some classes; the class with most won pairs (then the larger sum of
    margins, then the first by name) is predicted, with its weakest pair's confidence."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.classes = sorted(set(y.tolist()))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        self.w = np.zeros((x.shape[1] + 1, len(self.pairs)))
        for k, (a, b) in enumerate(self.pairs):
            use = (y == self.classes[a]) | (y == self.classes[b])
            self.w[:, k] = fit_pair(x[use], np.where(y[use] == self.classes[a], 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margin = x @ self.w[:-1] + self.w[-1]
        n = len(self.classes)
        won, total = np.zeros((len(x), n)), np.zeros((len(x), n))
        sure = np.ones((len(x), n))
        for k, (a, b) in enumerate(self.pairs):
            m = margin[:, k]
            p = 1 / (1 + np.exp(np.clip(-4 * m, -50, 50)))
            won[:, a] += m >= 0
            won[:, b] += m < 0
            total[:, a] += m
            total[:, b] -= m
            sure[:, a] = np.minimum(sure[:, a], p)
            sure[:, b] = np.minimum(sure[:, b], 1 - p)
        best = np.argmax(won + 1e-3 * np.tanh(total), axis=1)
        return best, sure[np.arange(len(x)), best]


class LanguageModel:
    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        self.families = self.within = None
        if self.langs:
            fams = np.array([family_of(v) for v in langs])
            self.families = PairVote(x, fams)
            self.within = {f: PairVote(x[fams == f], langs[fams == f]) for f in self.families.classes}

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        fam, sure = self.families.predict(x)
        out, score = np.empty(len(x), object), sure.copy()
        for k, f in enumerate(self.families.classes):
            use = np.flatnonzero(fam == k)
            if len(use):
                vote = self.within[f]
                best, p = vote.predict(x[use])
                out[use] = [vote.classes[b] for b in best]
                score[use] *= p
        return out.tolist(), score


def _vectors(batches):
    for batch in batches:
        vectors = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array([None if v is None else v.tobytes() for v in vectors], pa.binary())],
            ["lang", "v"])


def fit(training: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Model from ``doc_id, text, lang`` rows (nulls in any of them are left out), on at most ``sample``
    different texts of each language: that many vectors reach the driver, whatever the corpus."""
    ready(training.sparkSession)
    rows = training.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
    got = bounded_sample(rows, "lang", sample).select("text", "lang").mapInArrow(_vectors, "lang string, v binary")
    got = sorted((r["lang"], bytes(r["v"])) for r in got.where("v is not null").collect())
    x = np.array([np.frombuffer(v, np.float32) for _, v in got]).reshape(len(got), DIM)
    return LanguageModel(x, np.array([lang for lang, _ in got], dtype=object))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Every column of ``docs`` with ``lang_pred`` and ``score`` (the confidence, 0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    Columns named like these two are replaced; every row gives a row; an empty table gives none.
    """
    from pyspark.sql import types as T

    ready(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches):
        for batch in batches:
            texts = batch.column(kept.index("text")).to_pylist()
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for at in range(0, len(texts) if model.langs else 0, 512):
                vectors = [(i, v) for i in range(at, min(at + 512, len(texts)))
                           if texts[i] and (v := features(texts[i])) is not None]
                if vectors:
                    where = [i for i, _ in vectors]
                    names, p = model.predict(np.array([v for _, v in vectors]))
                    for i, name in zip(where, names):
                        pred[i] = name
                    score[where] = p
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(pred, pa.string()), pa.array(score)],
                [*kept, "lang_pred", "score"])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return docs.select(*kept).mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: LanguageModel, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or scored below ``min_score``."""
    # Own columns under other names meanwhile: they may be called like the prediction's.
    own = {c: "text" if c == "text" else f"own_{i}_" for i, c in enumerate(docs.columns)}
    marked = predict(docs.select(*[F.col(c).alias(a) for c, a in own.items()]), model)
    return marked.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(
        *[F.col(a).alias(c) for c, a in own.items()])
