"""prefix_rank / percentiles against plain windows: hot keys, null keys, several weights."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tollgate.functions.ranking import max_gap, nearest_rank_percentiles, prefix_rank


def _data(spark, n=6000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        r = rnd.random()
        k = "hot" if r < 0.6 else (None if r < 0.65 else f"k{rnd.randrange(40)}")
        rows.append((k, i, rnd.randrange(5), rnd.randrange(3), float(rnd.randrange(200))))
    return spark.createDataFrame(rows, "k string, o long, w1 long, w2 long, v double")


def test_prefix_rank_matches_window(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")   # runs cross batches
    try:
        df = _data(spark)
        got = prefix_rank(df, ["k"], ["o"], weight=["w1", "w2"], partitions=11) \
            .select("k", "o", "cum_w1", "cum_w2", "n_w1", "n_w2")
        w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        exp = df.select("k", "o", F.sum("w1").over(w).alias("cum_w1"), F.sum("w2").over(w).alias("cum_w2"),
                        F.sum("w1").over(Window.partitionBy("k")).alias("n_w1"),
                        F.sum("w2").over(Window.partitionBy("k")).alias("n_w2"))
        assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)
        g = prefix_rank(df, [], ["o"], partitions=7).select("o", "cum", "n")
        assert sorted((r.o, r.cum, r.n) for r in g.collect()) == [(i, i + 1, 6000) for i in range(6000)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_percentiles_match_brute_force(spark):
    df = _data(spark, 3000, 5)
    got = {r.k: (r.p50, r.p95, r.p99) for r in
           nearest_rank_percentiles(df, "v", ["k"], (0.5, 0.95, 0.99), ("p50", "p95", "p99")).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.k, []).append(r.v)
    for k, vals in groups.items():
        vals.sort()
        exp = tuple(round(vals[min(int(round((len(vals) - 1) * p)), len(vals) - 1)], 4) for p in (0.5, 0.95, 0.99))
        assert got[k] == exp, k


def test_max_gap_matches_lag(spark):
    df = _data(spark, 2000, 9).filter(F.col("k").isNotNull()).select("k", (F.col("o") * 7 % 1009).alias("t"), "o")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "53")   # key runs cross batches
    try:
        got = {r.k: r.max_gap for r in max_gap(df, "k", "t", "o", partitions=6).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("k").orderBy("t", "o")
    exp = {r.k: r.g or 0 for r in df.withColumn("g", F.col("t") - F.lag("t").over(w)).groupBy("k")
           .agg(F.max("g").alias("g")).collect()}
    assert got == exp


def test_run_increase_matches_lag_window(spark):
    from tollgate.functions.ranking import run_increase
    rnd = random.Random(11)
    rows, level = [], {}
    for i in range(5000):
        k = "hot" if rnd.random() < 0.7 else f"s{rnd.randrange(12)}"
        w = rnd.randrange(3)
        level[(k, w)] = 0.0 if rnd.random() < 0.02 else level.get((k, w), 0.0) + rnd.randrange(4)   # resets
        rows.append((k, w, i, level[(k, w)]))
    df = spark.createDataFrame(rows, "k string, w int, o long, v double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "61")
    try:
        got = {(r.k, r.w): (r.increase, r.samples) for r in run_increase(df, ["k", "w"], ["o"], "v", partitions=9).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    win = Window.partitionBy("k", "w").orderBy("o")
    prev = F.lag("v").over(win)
    d = F.when(prev.isNull(), 0.0).when(F.col("v") >= prev, F.col("v") - prev).otherwise(F.col("v"))
    exp = {(r.k, r.w): (r.inc, r.n) for r in df.withColumn("d", d).groupBy("k", "w")
           .agg(F.sum("d").alias("inc"), F.count(F.lit(1)).alias("n")).collect()}
    assert got.keys() == exp.keys()
    for key, (inc, n) in exp.items():
        assert abs(got[key][0] - inc) < 1e-6 and got[key][1] == n


def test_percentiles_property(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 20)), min_size=1, max_size=60))
    def check(rows):
        df = spark.createDataFrame([(k, float(v)) for k, v in rows], "k string, v double")
        got = {r.k: (r.p50, r.p99) for r in nearest_rank_percentiles(df, "v", ["k"], (0.5, 0.99), ("p50", "p99"))
               .collect()}
        for k in {k for k, _ in rows}:
            vals = sorted(float(v) for kk, v in rows if kk == k)
            exp = tuple(vals[min(int(round((len(vals) - 1) * p)), len(vals) - 1)] for p in (0.5, 0.99))
            assert got[k] == exp

    check()


def test_hot_key_is_not_held(spark):
    """A key over many batches leaves batch by batch: the function yields as many rows as it has taken, whatever the key."""
    import numpy as np
    import pandas as pd
    from tollgate.functions import ranking

    taken = 0

    def batches():
        nonlocal taken
        for i in range(50):
            taken += 1000
            yield pd.DataFrame({"k": ["hot"] * 1000 if i < 49 else ["hot"] * 10 + ["next"] * 990, "_w": np.full(1000, 2)})

    given, last = 0, None
    for out in ranking._local_running_sums(["k"], ["_w"])(batches()):
        given += len(out)
        assert given == taken
        last = out
    assert last["_l_w"].iloc[9] == 2 * 49_010 and last["_l_w"].iloc[10] == 2 and last["_l_w"].iloc[-1] == 2 * 990
    df = spark.range(300_000).select(F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("k"), F.col("id").alias("o"))
    got = prefix_rank(df, ["k"], ["o"], partitions=6).groupBy("k").agg(F.max("cum").alias("top"), F.count_distinct("cum").alias("d"), F.max("n").alias("n"))
    assert sorted(map(tuple, got.collect())) == [("a", 294_000, 294_000, 294_000), ("b", 6_000, 6_000, 6_000)]


def test_only_large_keys_are_ranged(spark, monkeypatch):
    """Keys that fit one task are summed by a window, with no range partition and nothing written; a key over the bound is split as before."""
    from tollgate.functions import ranking

    df = _data(spark).withColumns({w: F.coalesce(w, F.lit(0).cast("long")) for w in ("w1", "w2")})
    win = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exp = sorted(df.select("*", F.sum("w1").over(win).alias("cum"), F.sum("w1").over(Window.partitionBy("k")).alias("n")).collect(), key=str)
    ranged, plain = [], ranking.range_partition
    monkeypatch.setattr(ranking, "range_partition", lambda d, *a, **k: ranged.append(d.select("k").distinct().collect()) or plain(d, *a, **k))
    got = prefix_rank(df, ["k"], ["o"], "w1")
    assert got.columns == [*df.columns, "_w", "cum", "n"]
    assert sorted(got.drop("_w").collect(), key=str) == exp and not ranged
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 1000)
    got = prefix_rank(df, ["k"], ["o"], "w1")
    assert got.columns == [*df.columns, "_w", "cum", "n"]
    assert sorted(got.drop("_w").collect(), key=str) == exp
    assert [[r.k for r in keys] for keys in ranged] == [["hot"]]
    two = prefix_rank(df, ["k"], ["o"], ["w1", "w2"], totals=False)
    assert two.columns == [*df.columns, "cum_w1", "cum_w2"] and two.count() == 6000


def test_percentiles_of_many_groups_write_nothing(spark, monkeypatch):
    from tollgate.functions import ranking
    from tollgate.operators import usage

    samples = spark.range(4000).select((F.col("id") % 100).alias("workload"), (F.col("id") * 7919 % 4001).alias("cpu_m"), (F.col("id") * 31 % 977).alias("mem_mib"))
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 0)
    by_ranges = sorted(map(tuple, usage.usage_profile(samples).collect()))
    monkeypatch.undo()
    monkeypatch.setattr(ranking, "range_partition", None)
    assert sorted(map(tuple, usage.usage_profile(samples).collect())) == by_ranges and len(by_ranges) == 100
