"""Training-log tables: goldens and the distributed scan against a window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.operators import curves as cv
from lexiscope.plans.ordering import indexed_scan


def test_moving_average_golden(spark):
    df = spark.createDataFrame([("r", i, float(i)) for i in (1, 2, 3, 4)], "run string, s int, loss double")
    got = [r.smoothed for r in cv.moving_average(df, "run", ["s"]).orderBy("s").collect()]
    assert got == [1.0, 1.5, 2.5, 3.5]
    # Series rows inside a larger log: eval rows are skipped, steps count every record.
    log = spark.createDataFrame([("r", 1, 1.0, True), ("r", 2, 9.0, False), ("r", 3, 2.0, True),
                                 ("r", 4, 3.0, True)], "run string, s int, loss double, t boolean")
    out = cv.moving_average(log, "run", ["s"], member=F.col("t")).orderBy("s").collect()
    assert [(r.step, r.smoothed) for r in out] == [(1, 1.0), (3, 1.5), (4, 2.5)]


def test_moving_average_wide_window(spark):
    rows = [("r", i, float(i % 7)) for i in range(1000)]
    df = spark.createDataFrame(rows, "run string, s int, loss double")
    got = [r.smoothed for r in cv.moving_average(df, "run", ["s"]).orderBy("s").collect()]
    vals = [x[2] for x in rows]
    w = 10
    exp = [round(sum(vals[max(0, i - w): i + 1]) / (i - max(0, i - w) + 1), 6) for i in range(1000)]
    assert got == exp


def test_indexed_scan_matches_window(spark, sf):
    log = fixtures.training_log(spark, sf)
    scanned = indexed_scan(log, "run", ["ts", "event_id"], ["eval_loss"], num_partitions=3)
    w = Window.partitionBy("run").orderBy("ts", "event_id")
    ref = log.select("event_id", (F.row_number().over(w) - 1).alias("i"))
    bad = scanned.join(ref, "event_id").where(F.col("idx") != F.col("i")).count()
    assert bad == 0 and scanned.count() == log.count()


def test_pick_best(spark):
    df = spark.createDataFrame([("a", None, 0), ("b", 0.2, 1), ("c", 0.2, 2)],
                               "run string, score double, pos int")
    assert cv.pick_best(df, "run", "score", "pos").first().run == "b"
    empty = df.where("false")
    assert cv.pick_best(empty, "run", "score", "pos", fallback="hub").first().run == "hub"
    assert cv.pick_best(df, "run", "score", "pos", explicit="x").first().run == "x"


def test_epoch_tables(spark):
    df = spark.createDataFrame(
        [("r", 1, 0.5, 1.0, None), ("r", 2, 1.0, 3.0, None), ("r", 3, 1.0, None, 9.0),
         ("r", 4, 1.5, None, 7.0), ("r", 5, 2.5, None, 5.0)],
        "run string, step int, epoch double, loss double, eval_loss double")
    m = {r.epoch: r.mean_loss for r in cv.epoch_mean_loss(cv.training_rows(df)).collect()}
    assert m == {1: 2.0}
    e = {r.epoch: r.eval_loss for r in cv.epoch_last_eval(df, "run", "step").collect()}
    assert e == {1: 9.0, 2: 5.0}  # 1.5 and 2.5 both round (half-even) to 2; the later wins


def test_moving_average_non_finite_losses(spark):
    import math
    rows = [("r", i, v) for i, v in enumerate([1.0, float("nan"), 3.0, 4.0, 5.0])]
    df = spark.createDataFrame(rows, "run string, s int, loss double")
    got = [r.smoothed for r in cv.moving_average(df, "run", ["s"]).orderBy("s").collect()]
    assert got[0] == 1.0 and math.isnan(got[1]) and math.isnan(got[2]) and got[3] == 3.5 and got[4] == 4.5
    inf = float("inf")
    vals = [1.0, inf, 3.0, -inf, 5.0, 6.0]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(vals)], "run string, s int, loss double")
    got = [r.smoothed for r in cv.moving_average(df, "run", ["s"]).orderBy("s").collect()]
    expected = [sum(vals[max(0, i - 1): i + 1]) / (i - max(0, i - 1) + 1) for i in range(len(vals))]
    for g, e in zip(got, expected):
        assert (math.isnan(g) and math.isnan(e)) or g == e, (got, expected)


def smoothed(spark, losses):
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(losses)], "run string, s int, loss double")
    return [r.smoothed for r in cv.moving_average(df, "run", ["s"]).orderBy("s").collect()]


def test_moving_average_of_any_magnitude(spark):
    assert smoothed(spark, [1e21, 1e21, 2.0, 4.0]) == [1e21, 1e21, 5e20, 3.0]
    assert smoothed(spark, [9e19] * 19) == [9e19] * 19
    got = smoothed(spark, [1e-11, 3e-11, 1e300, 1e-300, 8.0, 2.0])
    assert got[:2] == [0.0, 0.0] and got[4:] == [4.0, 5.0]
    assert all(abs(x - 5e299) < 1e284 for x in got[2:4])
    assert smoothed(spark, [0.0, -3e15, 3e15, -0.5]) == [0.0, -1.5e15, 0.0, 1499999999999999.75]


def test_exact_parts_keep_every_digit(spark):
    from lexiscope.plans import ordering as od
    values = [1.7e308, 4.9e-324, 0.1, 123456.789012345, 2.0 ** 53, 1e-11, -7.25e-6, 1e7, 9999999.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ids = od.part_ids(df, "v")
    total = [sum(r) for r in df.select(*[od.part_value(od.exact_part(F.col("v"), k), k) for k in ids]).collect()]
    assert all(abs(a - b) <= abs(b) * 1e-15 for a, b in zip(total, values)), total
    assert [total[i] for i in (2, 3, 4, 8)] == [values[i] for i in (2, 3, 4, 8)]
