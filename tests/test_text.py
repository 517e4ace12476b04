"""Golden rows for the text functions (FIXTURES.md section 5)."""

import pytest
from pyspark.sql import functions as F

from lexiscope.functions import text as tx
from lexiscope.operators import standardize as sd


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


CLEAN_GOLDEN = [
    ("It's <b>Nestlé's</b> Q3 &amp; won't", "it is nestle is q3 will not"),
    ("won’t", "wont"),
    ("up ? down", "up  down"),
    ("'data' isn't", "wouldata' is not"),
    ("a &#39; b", "a &#39; b"),
    ("&AMP; x", "&amp; x"),
    ("CAN'T", "cannot"),
    ("½ ﬁne", "12 fine"),
    ("?", ""),
    ("€5", "5"),
    ("x <5 and y> 3", "x 3"),
    ("a b\u001cc", "a b c"),
]


def test_clean_text_golden(spark):
    got = apply(spark, tx.clean_text, [i for i, _ in CLEAN_GOLDEN])
    assert got == [o for _, o in CLEAN_GOLDEN]


def test_clean_text_on_odd_inputs(spark):
    expected = {
        "\u00dcn\u00efc\u00f6d\u00e9\tTABS\x0bvt": "unicode tabs vt",
        "\ufb00 \ufb03 \u338f \u2460": "ff ffi kg 1",
        "He'll've  I'm": "he will have i am",
        "  \u3000lead": "lead",
        "<a\nhref>x</a>": "x",
        "x\u2003y\u00a0z": "x y z",
        "Stra\u00dfe \u0152uvre \u00c6sir": "strae uvre sir",
        "\U0001d400\U0001d401\U0001d402 bold": "abc bold",
        "a?b??c ?": "abc",
        "? a": "a",
        "": "",
    }
    assert dict(zip(expected, apply(spark, tx.clean_text, list(expected)))) == expected


def test_light_clean_and_strip(spark):
    vals = ["  a\r\nb?  ", "　x ", "?"]
    assert apply(spark, tx.light_clean, vals) == ["a  b", "x", ""]
    assert apply(spark, tx.py_strip, ["  a b  "]) == ["a b"]


def test_tokenize_golden(spark):
    got = apply(spark, tx.tokenize, ["U.S. firm's 3.5% gain;  (loss) a"])
    assert got == [["firm", "5%", "gain;", "(loss)"]]


def test_prompt(spark):
    assert apply(spark, lambda c: tx.with_prompt(c), ["X"])[0].endswith("Article:\nX")
    assert apply(spark, lambda c: tx.with_prompt(c, enabled=False), ["X"]) == ["X"]


@pytest.mark.parametrize("values,expected", [
    ([2.0, 0.0, -0.5, None, float("nan")], ["positive", "neutral", "negative", None, None]),
])
def test_label_numeric(spark, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.x for r in df.select("i", sd.normalise_label(df, "v").alias("x")).orderBy("i").collect()]
    assert got == expected


def test_label_string(spark):
    vals = [" Positive ", "-1", "1.0", "2", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r.x for r in df.select("i", sd.normalise_label(df, "v").alias("x")).orderBy("i").collect()]
    assert got == ["positive", "negative", None, None, None]


def test_label_encodings(spark):
    df = spark.createDataFrame([("positive",), ("negative",), ("neutral",)], "l string")
    none = spark.createDataFrame([(None,)], "l string").select(sd.encode_label(F.col("l"), "sign").alias("s"))
    assert none.first().s is None
    rows = df.select(sd.encode_label(F.col("l"), "index").alias("i"),
                     sd.encode_label(F.col("l"), "sign").alias("s")).collect()
    assert [(r.i, r.s) for r in rows] == [(0, 1), (1, -1), (2, 0)]
    back = df.select(sd.decode_label(sd.encode_label(F.col("l"), "index"), "index").alias("d")).collect()
    assert [r.d for r in back] == ["positive", "negative", "neutral"]


def test_required_and_alias_columns(spark):
    df = spark.createDataFrame([("a", "b")], "Title string, Other string")
    with pytest.raises(ValueError, match="Global Sentiment"):
        sd.standardise(df, "Title", "Global Sentiment", "headline")
    pairs = spark.createDataFrame([("A ", " s", 1)], "ctext string, text string, extra int")
    out = sd.prepare_pairs(pairs, mode="strip")
    assert out.columns == ["article", "summary"] and out.first().article == "A"
    with pytest.raises(ValueError):
        sd.resolve_pair_columns(spark.createDataFrame([("x",)], "body string"))
