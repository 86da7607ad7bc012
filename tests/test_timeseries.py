"""Counter resets, histogram quantile, hold islands, absence, vector matching."""

import datetime as dt

from pyspark.sql import functions as F

from tollgate.operators import timeseries as ts


def _t(m):
    return dt.datetime(2024, 1, 1, 0, m)


def test_counter_increase_with_reset(spark):
    rows = [("s", _t(0), 1.0), ("s", _t(1), 5.0), ("s", _t(2), 2.0), ("s", _t(3), 4.0), ("s", _t(6), 10.0)]
    df = spark.createDataFrame(rows, "svc string, ts timestamp, value double")
    got = {r.window_start.minute: r.increase for r in ts.counter_increase(df, ["svc"], window_seconds=300).collect()}
    # window [0,5): 1->5 (+4), 5->2 reset (+2), 2->4 (+2) = 8; window [5,10): single sample = 0
    assert got == {0: 8.0, 5: 0.0}


def test_histogram_quantile(spark):
    rows = [("a", 5.0, 10), ("a", 10.0, 50), ("a", 25.0, 90), ("a", float("inf"), 100),
            ("b", 5.0, 0), ("b", float("inf"), 4)]
    df = spark.createDataFrame(rows, "svc string, le double, bucket_count long")
    got = {r.svc: r.quantile_value for r in ts.histogram_quantile(df, 0.5, ["svc"]).collect()}
    assert got["a"] == 5.0 + (10.0 - 5.0) * (50 - 10) / (50 - 10)
    assert got["b"] == 5.0  # rank in +Inf bucket -> last finite bound
    q9 = {r.svc: r.quantile_value for r in ts.histogram_quantile(df, 0.9, ["svc"]).collect()}
    assert q9["a"] == 25.0


def test_alert_hold_islands(spark):
    steps = [("s", dt.datetime(2024, 1, 1, h), h in (1, 2, 3, 5, 7, 8)) for h in range(10)]
    df = spark.createDataFrame(steps, "svc string, hour timestamp, cond boolean")
    got = ts.alert_hold(df, ["svc"], "hour", "cond", 3600, 3600).collect()
    assert sorted((r.island_start.hour, r.island_end.hour) for r in got) == [(1, 3), (7, 8)]


def test_absent_and_vectors(spark):
    rows = [("s", dt.datetime(2024, 1, 1, h)) for h in (0, 1, 4)]
    df = spark.createDataFrame(rows, "svc string, ts timestamp")
    got = sorted(r.step.hour for r in ts.absent_steps(df, ["svc"], "ts", 3600).collect())
    assert got == [2, 3]
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, value double")
    right = spark.createDataFrame([("b", 9.0), ("c", 3.0)], "k string, value double")
    assert [r.k for r in ts.vec_and(left, right, ["k"]).collect()] == ["b"]
    assert [r.k for r in ts.vec_unless(left, right, ["k"]).collect()] == ["a"]
    assert sorted((r.k, r.value) for r in ts.vec_or(left, right, ["k"]).collect()) == [
        ("a", 1.0), ("b", 2.0), ("c", 3.0)]
    assert [r.k for r in ts.label_match(left, [("k", "=~", "a|c")]).collect()] == ["a"]


def test_trailing_max_matches_plain_window(spark):
    from pyspark.sql import Window
    rows = [("s", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=37 * i), float((i * 7919) % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "svc string, ts timestamp, v double")
    got = ts.trailing_agg(df, ["svc"], "ts", "v", 600, "max", bucket_seconds=900).select("ts", "max_over_time")
    w = Window.partitionBy("svc").orderBy(F.col("ts").cast("long")).rangeBetween(-600, 0)
    exp = df.select("ts", F.max("v").over(w).alias("max_over_time"))
    assert sorted(got.collect()) == sorted(exp.collect())
