import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside; rows carry them as extra columns.
CLASHING = ("score", "node", "part", "slot", "w", "h", "n", "ids", "rank", "bucket", "kind", "spans", "row", "line",
            "stratum", "class_id", "held_out", "train", "item_id", "lang_pred", "id_", "doc", "t", "sh", "fp")


def rows_of(texts):
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts):
        """Documents of (doc_id, text) pairs with clashing extra columns."""
        df = spark.createDataFrame(rows_of(texts), "doc_id long, text string, lang string, source string, n_chars long")
        return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])
    return make


@pytest.fixture(scope="session")
def odd_texts(spark, sf):
    """Real texts with nulls, blanks, a very long text, repeated ids and repeated rows."""
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "text").orderBy("doc_id").limit(60).collect()]
    long = " ".join(f"w{i % 977}x{i}" for i in range(120_000))
    return real + [real[5], real[5], (7, "another text under a used id"), (None, "a text without an id"),
                   (None, None), (1001, None), (1002, ""), (1003, " \t\n"), (1004, "one"), (1005, long),
                   (1006, "!!! ??? 123"), (1007, "x" * 50_000), (1008, "é中\U0001f600 café İẞ"),
                   (1009, "tab\tand\x0bvertical\x0cfeed\rreturn\n\nend "), (1010, "<|endoftext|> inside"),
                   (1011, "no break  space　wide")]


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, score string")
