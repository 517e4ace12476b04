"""op11 against a scan of all pairs in Python integers."""

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexiscope.llm import hard_negatives as hn


def brute(rows, is_anchor, positives=5, negatives=10):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if i not in kept or (label, q) < kept[i]:
            kept[i] = label, q

    def score(a, b):
        total = sum(x * y for x, y in zip(kept[a][1], kept[b][1]))
        return max(-(1 << 63), min((1 << 63) - 1, total))

    out = []
    for a in filter(is_anchor, kept):
        scored = sorted(((score(a, b), -b) for b in kept if b != a), reverse=True)
        same = [(s, -b) for s, b in scored if kept[-b][0] == kept[a][0]][:positives]
        for ps, p in same:
            fit = [(s, -b) for s, b in scored if kept[-b][0] != kept[a][0] and 30 * ps <= 100 * s <= 90 * ps]
            out += [(a, p, r + 1, b, ps, s) for r, (s, b) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, every=4, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("score", F.lit(1)).withColumn(
        "rank", F.lit("x")).withColumn("part", F.lit(0)).withColumn("q", F.lit("clash")).withColumn("grp", F.lit(0))
    given = hn.integer_rows(df)
    found = hn.mine(given, given.where(F.col("vec_id") % every == 0), **more)
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                  "positive_score": "bigint", "negative_score": "bigint"}
    return sorted(tuple(r) for r in found.collect())


def random_rows(n, d=16, seed=3, labels=4, clustered=0.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d)) * clustered
    label = rng.integers(0, labels, n)
    return [(i, int(c), (centres[c] + rng.normal(size=d) * 0.2).tolist()) for i, c in enumerate(label)]


def test_equals_a_scan_of_all_pairs(spark):
    rows = random_rows(600)
    got = mined(spark, rows, segment_values=1500, group_values=700)  # about 6 segments and 4 groups
    assert got == brute(rows, lambda i: i % 4 == 0) and len(got) > 1000


def test_lists_stop_early_and_stay_exact(spark):
    rows = random_rows(900, d=3, clustered=0.1, labels=3)
    ids = np.array([r[0] for r in rows])
    q = np.array([[math.floor(256 * x) for x in r[2]] for r in rows])
    lists = hn.Lists(ids, np.array([r[1] for r in rows]), q)
    met = [len(lists.read(q[a], ids != a, lambda s, t: (k := hn.kth(s, 5)) is not None and t < k)[0]) for a in range(0, 900, 9)]
    assert np.median(met) < 800  # the threshold ends reading before all rows are met
    assert mined(spark, rows, 9) == brute(rows, lambda i: i % 9 == 0)


def test_ties_repeated_vectors_and_zero_vectors(spark):
    rows = [(i, i % 3, [0.5, -0.25, 0.25 * (i % 2)]) for i in range(90)]
    rows += [(100 + i, i % 2, [0.0, 0.0, 0.0]) for i in range(20)] + [(200 + i, 1, [-0.5, 0.25, 0.0]) for i in range(8)]
    assert mined(spark, rows, segment_values=60) == brute(rows, lambda i: i % 4 == 0)


def test_odd_rows(spark):
    rows = random_rows(60, d=4)
    rows += [(1000, None, [1.0] * 4), (1004, 1, None), (1008, 1, [1.0, None, 1.0, 1.0]), (1012, 2, [1.0, float("nan"), 0.0, 0.0]),
             (1016, 2, [float("inf"), 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (1020, 1, []), (1024, 1, [0.3]),
             (1028, 2, [0.1] * 9), (1032, -1, [0.2] * 4), (1036, 9, [0.4] * 4), (-4, 1, [0.3] * 4), (-5, 2, [0.3] * 4),
             rows[4], rows[4], (8, 7, [9.0] * 4), (8, 0, [9.0] * 4), (8, 0, [-9.0] * 4)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 4 == 0)


def test_large_components(spark):
    # Not beyond 64 bits as integers, but their products are.
    rows = random_rows(40, d=3) + [(100 + i, i % 2, [1e12 * (i - 5), 1e13, -3e11 * i]) for i in range(12)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 4 == 0)
    one = hn.integer_rows(spark.createDataFrame([(1, 1, [1e300, -1e300, 1e17])], "vec_id long, label int, embedding array<double>"))
    assert one.first().q == [(1 << 63) - 1, -(1 << 63) + 1, hn.MOST_SCORE]


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0]), (4, 1, [1.0])]) == []  # no other label
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])]) == []  # no positive
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.5])]) == []  # a negative positive score


def test_vectors_become_rows_of_one_width():
    column = pa.chunked_array([pa.array([[1, 2], []], pa.list_(pa.int64())), pa.array([[3]], pa.list_(pa.int64()))])
    assert hn._matrix(column, 2).tolist() == [[1, 2], [0, 0], [3, 0]] and hn._width(column) == 2
