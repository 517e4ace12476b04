"""TF-IDF + linear SVM text classifier and the model-signal UDF surface (ML1-ML7).

* ML1 relational TF-IDF (fit on the training split only): vocabulary = the
  ``max_features`` most frequent terms (ties by term), smooth idf
  ``ln((1+n)/(1+df)) + 1``, L2-normalised rows.  The vocabulary is a top-k
  (``orderBy().limit()``), so it never needs a global window, and its size is
  bounded by ``max_features`` before it is broadcast.
* ML1 for Spark ML: ``RegexTokenizer`` + ``CountVectorizer`` + ``IDF`` with the
  missing ``+1`` folded into an ``ElementwiseProduct`` + ``Normalizer``.
* ML2: Spark has no kernel SVM; a class-weighted ``OneVsRest(LinearSVC)``, on TF-IDF rows or, for the RBF kernel, on
  random Fourier features built by expressions.
* ML3: per-class decision scores from ``rawPrediction``.
* ML4/ML6: caller-supplied models run as Arrow batch UDFs (``predict_batch_udf``),
  loaded once per Python worker.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import (CountVectorizer, ElementwiseProduct, IDF, Normalizer,
                                RegexTokenizer)
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiscope.functions.hashing import hex_slice_int

TOKEN_PATTERN = "[\\p{L}\\p{N}_]{2,}"  # maximal runs of >= 2 word characters
MAX_FEATURES = 10_000
SVM_C = 10.0
CLASS_NAMES = ("positive", "negative", "neutral")  # label index order


# ---- ML1 relational ---------------------------------------------------------------


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def tfidf_relational(docs: DataFrame, is_train: Column | None = None, id_col: str = "doc_id",
                     text_col: str = "text", max_features: int = MAX_FEATURES) -> DataFrame:
    """``(id, term, weight)`` for ``docs``, with vocabulary and idf fitted on the rows where ``is_train`` (all by default).

    Texts are split once: the counts per document and term serve the fit, which sums those of training rows, and the
    weights of all rows (one exchange, reused).
    """
    train = F.lit(True) if is_train is None else F.coalesce(is_train, F.lit(False))
    flagged = docs.select(id_col, train.alias("_train"), text_col)
    per_doc = flagged.select(id_col, "_train", F.explode(terms(F.col(text_col))).alias("term")).groupBy(
        id_col, "_train", "term").agg(F.count(F.lit(1)).alias("tf"))
    # Sums of training rows by condition: a filter would be pushed down and split the texts again.
    stats = per_doc.groupBy("term").agg(F.sum(F.when(F.col("_train"), F.col("tf"))).alias("tf_total"),
                                        F.count_if("_train").alias("df")).where("tf_total is not null")
    vocab = stats.orderBy(F.col("tf_total").desc(), F.col("term")).limit(max_features)
    n_train = flagged.agg(F.count_distinct(F.when(F.col("_train"), F.col(id_col))).alias("n_train"))
    idf = vocab.crossJoin(F.broadcast(n_train)).select(  # one row
        "term", (F.log((1.0 + F.col("n_train")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    # <= max_features rows
    weighted = per_doc.join(F.broadcast(idf), "term").select(id_col, "term", (F.col("tf") * F.col("idf")).alias("w"))
    # Row norm with a window per document (bounded by its distinct terms)
    # instead of a second aggregate joined back.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return weighted.select(id_col, "term", F.round(F.col("w") / norm, 9).alias("weight"))


# ---- ML1-ML3, ML7 with Spark ML -------------------------------------------------------


def fit_tfidf(train: DataFrame, text_col: str = "text",
              max_features: int = MAX_FEATURES) -> PipelineModel:
    """Features pipeline fitted on the training rows only."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_PATTERN,
                         gaps=False, toLowercase=True, minTokenLength=2)
    cv = CountVectorizer(inputCol="_tokens", outputCol="_tf", vocabSize=max_features)
    idf = IDF(inputCol="_tf", outputCol="_idf")
    base = Pipeline(stages=[tok, cv, idf]).fit(train)
    idf_vec = base.stages[2].idf.toArray()
    plus_one = ElementwiseProduct(inputCol="_tf", outputCol="_tfidf",
                                  scalingVec=Vectors.dense(idf_vec + 1.0))
    norm = Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)
    return PipelineModel(stages=[base.stages[0], base.stages[1], plus_one, norm])


def fit_svm(train_features: DataFrame, label_col: str = "label_index",
            weight_col: str = "weight", c: float = SVM_C, max_iter: int = 100):
    """ML2: class-weighted one-vs-rest linear SVM; ``regParam = 1 / (C * n)``.

    Features are already L2-normalised TF-IDF, so no extra standardisation
    (the reference's SVM does not standardise either).
    """
    n = train_features.count()
    svc = LinearSVC(featuresCol="features", labelCol=label_col, weightCol=weight_col,
                    regParam=1.0 / (c * max(n, 1)), maxIter=max_iter, standardization=False)
    # The k binary problems are independent: fit them concurrently.
    return OneVsRest(classifier=svc, featuresCol="features", labelCol=label_col,
                     weightCol=weight_col, parallelism=len(CLASS_NAMES)).fit(train_features)


# ---- ML2: RBF kernel approximated by random Fourier features ---------------

#: Components computed together, one row of sums for each block of a document; an even number.
RFF_BLOCK = 64
HASH_UNITS = float(1 << 48)


def _uniforms(h: Column) -> tuple[Column, Column]:
    """Two uniform numbers of an md5, the first above 0."""
    return (hex_slice_int(h, 1, 12) + 1) / F.lit(HASH_UNITS), hex_slice_int(h, 13, 12) / F.lit(HASH_UNITS)


def frequencies(vocabulary: DataFrame, n_components: int, seed: int = 42) -> DataFrame:
    """``(term, block, w)``: each term's standard normal frequencies, RFF_BLOCK of them a row.

    Box-Muller on the md5 of seed, pair of components and term, so any engine builds the same numbers and no worker
    holds the matrix.  (Rahimi & Recht 2007; the kernel's scale enters in :func:`rff_components`.)
    """
    if n_components % RFF_BLOCK:
        raise ValueError(f"n_components must be a multiple of {RFF_BLOCK}")
    blocks = vocabulary.select("term", F.explode(F.sequence(F.lit(0), F.lit(n_components // RFF_BLOCK - 1))).alias("block"))

    def pair(k: Column) -> Column:
        h = F.md5(F.concat_ws(":", F.lit(str(seed)), k.cast("string"), F.col("term")).cast("binary"))
        u, v = _uniforms(h)
        radius, angle = F.sqrt(-2.0 * F.log(u)), F.lit(2 * math.pi) * v
        return F.array(radius * F.cos(angle), radius * F.sin(angle))

    half = RFF_BLOCK // 2
    ks = F.sequence(F.col("block") * half, F.col("block") * half + half - 1)
    return blocks.select("term", "block", F.flatten(F.transform(ks, pair)).alias("w"))


def rff_components(weights: DataFrame, n_components: int = 256, gamma: float = 1.0, seed: int = 42,
                   id_col: str = "doc_id") -> DataFrame:
    """``(id, component, value)``: RBF feature map ``sqrt(2/D) * cos(sqrt(2 gamma) x.w + b)`` of TF-IDF rows.

    ``weights`` is ``(id, term, weight)`` (see :func:`tfidf_relational`).  The frequencies of its terms (at most
    ``max_features`` times ``n_components`` doubles) are broadcast; a document's projections are sums per block of
    components, combined map-side.
    """
    table = frequencies(weights.select("term").distinct(), n_components, seed)
    sums = weights.join(F.broadcast(table), "term").groupBy(id_col, "block").agg(
        *[F.sum(F.col("weight") * F.col("w")[i]).alias(f"z{i}") for i in range(RFF_BLOCK)])
    each = sums.select(id_col, "block", F.posexplode(F.array(*[f"z{i}" for i in range(RFF_BLOCK)])).alias("i", "z"))
    component = (F.col("block") * RFF_BLOCK + F.col("i")).alias("component")
    each = each.select(id_col, component, "z")
    _, v = _uniforms(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("phase"), F.col("component").cast("string")).cast("binary")))
    value = F.lit(math.sqrt(2.0 / n_components)) * F.cos(F.lit(math.sqrt(2.0 * gamma)) * F.col("z") + F.lit(2 * math.pi) * v)
    return each.select(id_col, "component", value.alias("value"))


def rff_features(weights: DataFrame, n_components: int = 256, gamma: float = 1.0, seed: int = 42,
                 id_col: str = "doc_id") -> DataFrame:
    """:func:`rff_components` as one ``features`` vector a document."""
    from pyspark.ml.functions import array_to_vector

    parts = rff_components(weights, n_components, gamma, seed, id_col).groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("component", "value"))).alias("x"))  # n_components of them
    return parts.select(id_col, array_to_vector(F.transform("x", lambda e: e["value"])).alias("features"))


def rbf_gamma_scale(weights: DataFrame, n_docs: int, n_features: int) -> float:
    """``gamma='scale'`` = 1 / (n_features * Var(X)) over all cells of the
    (n_docs x n_features) TF-IDF matrix, zeros included; one aggregate."""
    st = weights.agg(F.sum("weight").alias("s"), F.sum(F.col("weight") ** 2).alias("q")).first()
    cells = float(n_docs) * n_features
    var = (st["q"] or 0.0) / cells - ((st["s"] or 0.0) / cells) ** 2
    return 1.0 / (n_features * var) if var > 0 else 1.0


def decision_scores(predictions: DataFrame) -> Column:
    """ML3: ``MAP<label, score>`` from ``rawPrediction``, 4 places."""
    raw = vector_to_array(F.col("rawPrediction"))
    return F.map_from_arrays(F.array(*[F.lit(c) for c in CLASS_NAMES]),
                             F.transform(raw, lambda x: F.round(x, 4)))


def save_model(model, path: str) -> None:
    """ML7: persist a fitted model (overwriting)."""
    model.write().overwrite().save(path)


# ---- ML4 / ML6: caller-supplied models --------------------------------------------


def batch_classifier(make_predict_fn: Callable, batch_size: int = 64) -> Callable[[Column], Column]:
    """ML4: wrap a caller's model as an Arrow batch UDF returning class logits.

    ``make_predict_fn()`` runs once per Python worker (load weights there) and
    returns ``predict(texts: np.ndarray) -> np.ndarray[n, 3]``; decode the
    logits with :func:`lexiscope.operators.report.softmax_decode`.
    """
    return predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()),
                             batch_size=batch_size)


def batch_summariser(make_predict_fn: Callable, batch_size: int = 16) -> Callable[[Column], Column]:
    """ML6: wrap a caller's summariser (``texts -> summaries``) as an Arrow batch UDF."""
    return predict_batch_udf(make_predict_fn, return_type=T.StringType(), batch_size=batch_size)


def hashed_logits_model():
    """Deterministic stand-in for a classifier, for tests: logits from text bytes."""
    def predict(texts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), 3))
        for i, t in enumerate(texts):
            b = (t or "").encode("utf-8")
            out[i] = [sum(b[0::3]) % 7, sum(b[1::3]) % 7, sum(b[2::3]) % 7]
        return out
    return predict
