"""Standardise, normalise, filter and stitch labelled text.

All steps are column expressions or narrow filters; reads are lazy, so one
source's standardise + clean + filter is a single stage.  The only shuffle is
the de-duplication in :func:`stitch` (U1).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiscope.functions import text as tx

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# --------------------------------------------------------------------------

# String label -> normalised label (after strip + lower); anything else is null.
STRING_LABELS = {
    "positive": "positive",
    "negative": "negative",
    "neutral": "neutral",
    "1": "positive",
    "0": "neutral",
    "-1": "negative",
}
# Integer encodings of the normalised label.
LABEL_INDEX = {"positive": 0, "negative": 1, "neutral": 2}
LABEL_SIGN = {"positive": 1, "negative": -1}  # anything else -> 0
STANDARD_COLUMNS = ("data", "datatype", "sentiment")
PAIR_ALIASES = (("ctext", "text"), ("article", "summary"), ("article", "highlights"))


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """P5: plan-time check naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def normalise_label(df: DataFrame, column: str) -> Column:
    """Numeric column -> sign label; string column -> exact map; else null."""
    field = df.schema[column].dataType
    col = F.col(column)
    if isinstance(field, T.NumericType):
        signed = (F.when(col > 0, F.lit("positive")).when(col < 0, F.lit("negative"))
                  .when(col == 0, F.lit("neutral")))
        if isinstance(field, (T.FloatType, T.DoubleType)):
            # A missing value is null, and Spark orders NaN above every number.
            return F.when(F.isnan(col), F.lit(None).cast("string")).otherwise(signed)
        return signed
    key = F.lower(tx.py_strip(col.cast("string")))
    pairs = []
    for k, v in STRING_LABELS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), key)


def encode_label(label: Column, scheme: str = "index") -> Column:
    """``index`` = {positive 0, negative 1, neutral 2}; ``sign`` = {1, -1, 0}; no label, no code."""
    if scheme == "index":
        out = None
        for k, v in LABEL_INDEX.items():
            out = (F.when(label == k, F.lit(v)) if out is None else out.when(label == k, F.lit(v)))
        return out
    if scheme == "sign":
        return (F.when(label == "positive", F.lit(1)).when(label == "negative", F.lit(-1))
                .when(label == "neutral", F.lit(0)))
    raise ValueError("scheme must be 'index' or 'sign'")


def decode_label(code: Column, scheme: str = "index") -> Column:
    if scheme == "index":
        return F.element_at(F.array(*[F.lit(k) for k in LABEL_INDEX]), code + 1)
    if scheme == "sign":
        return (F.when(code == 1, F.lit("positive")).when(code == -1, F.lit("negative"))
                .when(code == 0, F.lit("neutral")))
    raise ValueError("scheme must be 'index' or 'sign'")


def standardise(df: DataFrame, data_col: str, label_col: str, datatype: str) -> DataFrame:
    """P1 + P2 + P3: rename, constant datatype, label normalised, nulls/blanks dropped."""
    require_columns(df, [data_col, label_col])
    out = df.select(F.col(data_col).cast("string").alias("data"),
                    F.lit(datatype).alias("datatype"),
                    normalise_label(df, label_col).alias("sentiment"))
    return drop_blank(out.dropna(subset=["data", "sentiment"]))


def nonempty(df: DataFrame, column: str, expr: Column) -> DataFrame:
    """Replace ``column`` by ``expr`` and drop rows where it is null or empty.

    A plain ``where`` on the new column would be pushed below the projection
    with ``expr`` substituted into it, evaluating an expensive expression
    (the cleaning chain, its Arrow UDF) twice.  Emitting the value through a
    0-or-1-element ``explode`` keeps it computed once: filters are never
    pushed below a generator's output.
    """
    others = [F.col(c) for c in df.columns if c != column]
    kept = F.filter(F.array(expr), lambda v: v.isNotNull() & (v != ""))
    out = df.select(*others, F.explode(kept).alias(column))
    return out.select(*df.columns)


def drop_blank(df: DataFrame, column: str = "data") -> DataFrame:
    """Strip (Unicode whitespace) and drop empty strings."""
    return nonempty(df, column, tx.py_strip(F.col(column)))


def clean_standardised(df: DataFrame) -> DataFrame:
    """T5 on ``data``, then drop rows cleaned to nothing (P3 again)."""
    return nonempty(df, "data", tx.clean_text(F.col("data")))


def stitch(frames: Sequence[DataFrame]) -> DataFrame:
    """Union-all, then de-duplicate on all three columns (one shuffle)."""
    out = frames[0].select(*STANDARD_COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*STANDARD_COLUMNS))
    return out.dropDuplicates(list(STANDARD_COLUMNS))


def standardise_job(sources: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Each ``(df, data_col, label_col, datatype)`` -> standardise -> clean -> stitch."""
    return stitch([clean_standardised(standardise(df, d, lbl, dt)) for df, d, lbl, dt in sources])


def resolve_pair_columns(df: DataFrame) -> DataFrame:
    """``ctext/text`` or ``article/summary`` -> ``article, summary``; others dropped."""
    for art, summ in PAIR_ALIASES:
        if art in df.columns and summ in df.columns:
            rest = [c for c in ("split",) if c in df.columns]
            return df.select(F.col(art).alias("article"), F.col(summ).alias("summary"), *rest)
    raise ValueError(f"unexpected pair columns: {df.columns}")


def prepare_pairs(df: DataFrame, mode: str = "light") -> DataFrame:
    """Resolve pair columns; ``light`` = T6 on both, ``strip`` = P4 only."""
    pairs = resolve_pair_columns(df)
    fn = tx.light_clean if mode == "light" else tx.py_strip
    return pairs.withColumn("article", fn(F.col("article"))).withColumn(
        "summary", fn(F.col("summary")))


def drop_incomplete_pairs(df: DataFrame) -> DataFrame:
    """Pairs with a null or blank side are dropped (before training)."""
    return df.where(F.col("article").isNotNull() & F.col("summary").isNotNull()
                    & (tx.py_strip(F.col("article")) != "")
                    & (tx.py_strip(F.col("summary")) != ""))


def guard_nonempty(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(accepted with stripped text, rejected rows) - an empty article is an error."""
    stripped = tx.py_strip(F.col(text_col))
    ok = F.col(text_col).isNotNull() & (stripped != "")
    return (df.where(ok).withColumn(text_col, stripped), df.where(~ok | F.col(text_col).isNull()))
