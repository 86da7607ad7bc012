"""Streaming jobs over several, out-of-order micro-batches, restarts and repeated batches."""

import os
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tollgate.session import checkpoint_root
from tollgate.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def _run(spark, d):
    s = J.table_stream(spark, SF, "events").select("event_id", "ts")
    q = (s.writeStream.outputMode("append").format("parquet").option("path", f"{d}/data")
          .option("checkpointLocation", f"{d}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(p["numInputRows"] for p in q.recentProgress)


def test_restart_resumes_from_checkpoint(spark):
    d = os.path.join(checkpoint_root(spark), f"test-restart-{os.getpid()}")
    first = _run(spark, d)
    n = spark.read.parquet(f"{d}/data").count()
    assert first == n == spark.read.parquet(f"{SF}/events.parquet").count()
    second = _run(spark, d)                     # restart on the same checkpoint: nothing new
    assert second == 0
    assert spark.read.parquet(f"{d}/data").count() == n


START = datetime(2024, 1, 1)


def _at(minutes):
    return START + timedelta(minutes=minutes)


def _stream(spark, rows, schema, batches):
    """Rows as a stream, one micro-batch for each list of row numbers."""
    folder = os.path.join(checkpoint_root(spark), f"test-batches-{uuid.uuid4().hex}")
    for some in batches:
        spark.createDataFrame([rows[i] for i in some], schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 1).parquet(folder)


def _holds(rows, hold, delay):
    """Plain twin: one-minute steps, closed ones only, runs of steps that hold."""
    newest = max(t for _, t, _ in rows)
    steps = {}
    for service, t, slow in rows:
        steps[service, t.replace(second=0)] = steps.get((service, t.replace(second=0)), True) and slow
    fired, start, done = [], {}, set()
    for (service, t), holds in sorted(steps.items()):
        if t + timedelta(minutes=1) > newest - delay:
            continue
        if not holds:
            start.pop(service, None)
            continue
        s = start.setdefault(service, t)
        if (t - s).total_seconds() >= hold and (service, s) not in done:
            done.add((service, s))
            fired.append((service, s, t))
    return sorted(fired)


def _hold_rows():
    """Two services; 'a' has a fast row in the middle of what else would be one run."""
    rows = [("a", _at(m) + timedelta(seconds=7 * (m % 8)), m not in (14, 60)) for m in range(0, 90)]
    rows += [("b", _at(m), m % 20 < 12) for m in range(0, 90, 2)]
    return rows + [("b", _at(m), False) for m in (23, 24)] + [("c", _at(180), True)]


@pytest.mark.parametrize("batches", ["one", "four", "late"])
def test_alert_hold_does_not_depend_on_batches(spark, batches):
    rows = _hold_rows()
    order = sorted(range(len(rows)), key=lambda i: rows[i][1])
    cut = [order]
    if batches == "four":                        # in time order, four files
        n = len(order) // 4 + 1
        cut = [order[i:i + n] for i in range(0, len(order), n)]
    elif batches == "late":                      # the fast row of minute 14 comes after rows up to 9 minutes newer
        late = [i for i in order if rows[i][1] < _at(15) and not rows[i][2]]
        first = [i for i in order if rows[i][1] < _at(22) and i not in late]
        cut = [first, late, [i for i in order if _at(22) <= rows[i][1] < _at(50)][::-1], [i for i in order if rows[i][1] >= _at(50)]]
    log = _stream(spark, rows, "service string, ts timestamp, slow boolean", cut)
    out = J.run_alert_hold(log, "slow", 300, "test_alert_hold")
    want = _holds(rows, 300, timedelta(minutes=10))
    assert sorted(map(tuple, out.collect())) == want and len({s for s, _, _ in want}) == 2


def test_alert_hold_hot_and_null(spark):
    """A null condition is no true one; many rows of one service are as many groups as steps."""
    rows = [("a", _at(m) + timedelta(milliseconds=k), None if m == 30 else True) for m in range(60) for k in range(50)] + [("z", _at(120), True)]
    log = _stream(spark, rows, "service string, ts timestamp, slow boolean", [range(len(rows))])
    out = J.run_alert_hold(log, "slow", 600, "test_alert_hot")
    assert sorted(map(tuple, out.collect())) == [("a", _at(0), _at(10)), ("a", _at(31), _at(41))]


def test_watcher_reports_silent_and_unseen_assets(spark):
    rows = [("raw", _at(0)), ("candidate", _at(1)), ("raw", _at(5)), ("raw", _at(9))]
    budgets = spark.createDataFrame([("raw", 60), ("candidate", 300), ("never", 30)], "asset string, budget_s int")
    reports = {}
    for name, cut in (("one", [range(4)]), ("three", [[0, 1], [3], [2]])):
        stream = J.stream_last_seen(_stream(spark, rows, "asset string, ts timestamp", cut))
        out = J.run_foreach_batch(stream, f"test_watch_{name}", lambda d, _: J.watcher_lag(d, budgets), mode="complete").collect()
        last = max(r.batch_id for r in out)
        reports[name] = sorted((r.asset, r.lag_s, r.within_budget) for r in out if r.batch_id == last)
        if name == "three":                      # 'candidate' has no event in the second batch and is reported late
            assert ("candidate", 480, False) in [(r.asset, r.lag_s, r.within_budget) for r in out if r.batch_id == 1]
    assert reports["one"] == reports["three"] == [("candidate", 480, False), ("never", None, False), ("raw", 0, True)]


def test_repeated_batch_adds_nothing(spark):
    path = os.path.join(checkpoint_root(spark), f"test-sink-{uuid.uuid4().hex}")
    sink = J.batch_sink(path, lambda d, i: d.withColumn("twice", F.col("id") * 2))
    for batch_id, n in ((0, 5), (1, 7), (1, 7), (0, 5)):
        sink(spark.range(n), batch_id)
    assert spark.read.parquet(path).count() == 12


def test_scores_are_those_of_the_batch(spark):
    """Streamed scores equal P4; a version registered between two batches scores from the second on."""
    from tollgate.operators import model as mdl
    from tollgate.sources import bindings as b

    rows = b.churn_split(spark, SF)
    models = mdl.model_table(spark, rows.filter("split = 'train'"))
    requests = spark.range(40).select(F.col("id").alias("request_id"), F.current_timestamp().alias("ts"), F.col("id").alias("user_id"),
                                      F.when(F.col("id") % 3 == 0, "2026.07.0").when(F.col("id") % 3 == 1, "2026.07.1").otherwise("none").alias("version"))
    want = {(r.c_custkey, r.version): (r.churn_score, r.prediction) for r in mdl.score(rows, models, keep=["c_custkey"]).collect()}
    got = J.stream_score(requests, rows, models).collect()
    assert len(got) == 40
    for r in got:
        assert (r.churn_score, r.high_risk) == want.get((r.request_id, r.version), (None, None))
    before = J.stream_score(requests, rows, models.filter("version = '2026.07.0'")).filter("churn_score is null").count()
    assert before > J.stream_score(requests, rows, models).filter("churn_score is null").count()
