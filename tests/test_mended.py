"""Cases that small single-file inputs do not show."""

import pytest

from tollgate import session
from tollgate.operators import evidence, timeseries
from tollgate.sources import io


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    (tmp_path / "b.csv").write_text("a0,a,b\n9,2,y\n")
    got = sorted(map(tuple, io.read_csv(spark, str(tmp_path), ["a", "b", "c"]).collect()))
    assert got == [("1", "x", None), ("2", "y", None)]
    assert io.read_csv(spark, str(tmp_path / "none"), ["a"]).count() == 0


def test_group_left_refuses_a_repeated_one_side(spark):
    many = spark.createDataFrame([("n1", 2.0), ("n2", 3.0)], "node string, value double")
    one = spark.createDataFrame([("n1", 5.0), ("n2", 7.0)], "node string, value double")
    assert sorted(r["value"] for r in timeseries.vec_group_left(many, one, ["node"]).collect()) == [10.0, 21.0]
    with pytest.raises(Exception, match="repeats n1"):
        timeseries.vec_group_left(many, one.union(one.filter("node = 'n1'")), ["node"]).collect()


def test_trace_depth_reports_cycles(spark):
    spans = spark.createDataFrame([("t", "a", None), ("t", "b", "a"), ("t", "c", "b"), ("u", "x", "y"), ("u", "y", "x"), ("u", "z", "y")],
                                  "trace_id string, span_id string, parent_span_id string")
    got = {(r["trace_id"], r["span_id"]): r["depth"] for r in evidence.trace_depth(spans).collect()}
    assert got == {("t", "a"): 0, ("t", "b"): 1, ("t", "c"): 2, ("u", "x"): None, ("u", "y"): None, ("u", "z"): None}


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_files_are_read_in_blocks(spark, tmp_path, monkeypatch):
    import hashlib

    monkeypatch.setattr(io, "BLOCK_BYTES", 10)
    (tmp_path / "in").mkdir()
    texts = {"a.txt": "one\ntwo\nthree\n" * 9, "b.txt": "no line break at all, longer than a block", "d.txt": "é" * 25 + "\nend"}
    for name, text in texts.items():
        (tmp_path / "in" / name).write_text(text)
    got = {r["path"]: (r["sha256"], r["bytes"]) for r in io.file_manifest(spark, str(tmp_path / "in"), "*.txt").collect()}
    assert got == {n: (hashlib.sha256(t.encode()).hexdigest(), len(t.encode())) for n, t in texts.items()}
    blocks = {}
    for r in sorted(io.corpus_text_scan(spark, str(tmp_path / "in")).collect(), key=lambda r: r["block"]):
        blocks.setdefault(r["path"].split("/")[-1], []).append(r["text"])
    assert {n: "".join(b) for n, b in blocks.items()} == texts
    assert len(blocks["a.txt"]) > 5 and all(b.endswith("\n") for b in blocks["a.txt"])


def test_absent_reports_silent_stopped_and_unseen_series(spark):
    rows = [("a", f"2024-01-0{d} {h:02d}:15:00") for d in (1, 2, 3) for h in range(24) if (d, h) != (2, 5)] + [("stopped", "2024-01-01 00:30:00"), ("late", "2024-01-03 23:00:00")]
    df = spark.createDataFrame(rows, "s string, t string").selectExpr("s", "cast(t as timestamp_ntz) as t")
    expected = spark.createDataFrame([("a",), ("stopped",), ("late",), ("never",)], "s string")
    got = {r["s"]: r["count"] for r in timeseries.absent_steps(df, ["s"], "t", 3600, expected).groupBy("s").count().collect()}
    assert got == {"a": 1, "stopped": 71, "late": 71, "never": 72}


def test_sliding_rate_counts_resets_at_every_edge(spark):
    import random

    rng = random.Random(1)
    rows, v = [], 0.0
    for i in range(400):
        v = 0.0 if rng.random() < 0.1 else v + rng.randrange(5)
        rows.append(("a" if i % 3 else "b", i * 47, v))
    df = spark.createDataFrame(rows, "s string, t long, v double").selectExpr("s", "v", "cast(timestamp_seconds(t) as timestamp_ntz) as ts")
    got = {(r["s"], int(r["w"])): (r["increase"], r["samples"]) for r in timeseries.sliding_increase(df, ["s"], "ts", "v", 1200, 300)
           .selectExpr("s", "unix_timestamp(cast(window_start as timestamp)) as w", "increase", "samples").collect()}
    want = {}
    for s in ("a", "b"):
        for w in range(-900, 400 * 47, 300):
            inside = [x for n, t, x in rows if n == s and w <= t < w + 1200]
            if inside:
                want[s, w] = (sum(y - x if y >= x else y for x, y in zip(inside, inside[1:], strict=False)), len(inside))
    assert got == want


def test_deadlines_by_policy(spark):
    from tollgate.operators import release

    at = [("k", 0, "a"), ("k", 590, "b"), ("k", 700, "a"), ("k", 1301, "b"), ("k", 5000, "a"), ("z", 5000, "a"), (None, 0, "a"), ("z", 5300, "c"), ("k", 1300, "a"), ("k", 1300, "b"), ("q", 10, "c")]
    events = spark.createDataFrame([(i, *x) for i, x in enumerate(at)], "id int, key string, t long, event string").selectExpr("id", "key", "timestamp_seconds(t) as ts", "event")
    policies = spark.createDataFrame([("p", "a", "b", 600, "page"), ("q", "c", "a", 7200, "ticket")], "policy string, a string, b string, limit_s int, severity string")
    got = sorted((r["policy"], r["id"], r["status"]) for r in release.deadline_policies(events, policies).collect())
    assert got == [("p", 0, "met"), ("p", 2, "met"), ("p", 4, "open"), ("p", 5, "open"), ("p", 8, "met"), ("q", 7, "open"), ("q", 10, "open")]
    late = spark.createDataFrame([(0, "k", 0, "a"), (1, "k", 601, "b")], "id int, key string, t long, event string").selectExpr("id", "key", "timestamp_seconds(t) as ts", "event")
    assert [r["status"] for r in release.deadline_policies(late, policies).collect()] == ["missed"]


def test_missing_evidence_fails(spark):
    from tollgate.operators import release

    observed = spark.createDataFrame([("s", "m1", 1.0), ("t", "m1", 1.0), ("t", "m2", 9.0)], "service string, metric string, observed double")
    budgets = spark.createDataFrame([("m1", 2.0, True), ("m2", 5.0, False)], "metric string, budget double, lower_is_better boolean")
    got = sorted((r["service"], r["metric"], r["passed"], r["recommended_action"][:5]) for r in release.performance_budget(observed, budgets, ["service"]).collect())
    assert got == [("s", "m1", True, "freez"), ("s", "m2", False, "freez"), ("t", "m1", True, "allow"), ("t", "m2", True, "allow")]
    idle = spark.createDataFrame([(True, True, None, None, 0, 5)], "gates_passed boolean, drift_passed boolean, latency_p95 double, error_rate double, queued_jobs int, available_slots int")
    r = release.release_policy(idle).first()
    assert (r["all_checks_passed"], r["action"]) == (False, "hold")


def test_pivot_keeps_unseen_values(spark):
    spans = spark.createDataFrame([("t", "a", 1.0), ("t", "new", 2.5), ("t", "a", 1.0), ("u", None, 4.0)], "trace_id string, service string, d double")
    from pyspark.sql import functions as F
    got = {r["trace_id"]: (r["pivot"], r["rows"]) for r in evidence.trace_pivot(spans, ["trace_id"], "service", F.col("d")).collect()}
    assert got == {"t": ({"a": 2.0, "new": 2.5}, 3), "u": ({"unknown": 4.0}, 1)}


SPAN = "trace_id string, span_id string, parent_span_id string"


def _all_depths(df):
    return sorted(((r["trace_id"], r["span_id"], r["depth"]) for r in df.collect()), key=str)


def test_trace_depth_writes_no_round(spark, monkeypatch):
    """Bounded traces are solved in one shuffle; only larger ones are joined and checkpointed round by round."""
    from pyspark.sql.classic.dataframe import DataFrame

    written = []
    plain = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: written.append(1) or plain(self, *a, **k))
    rows = [(f"t{i % 40}", f"s{i // 40}", f"s{i // 40 - 1}" if i >= 40 else None) for i in range(40 * 30)]
    rows += [("wide", f"w{i}", "w0" if i else None) for i in range(300)]
    spans = spark.createDataFrame(rows, SPAN).repartition(7)
    want = sorted(((t, s, int(s[1:]) if t != "wide" else int(s != "w0")) for t, s, _ in rows), key=str)
    assert _all_depths(evidence.trace_depth(spans)) == want and not written
    monkeypatch.setattr(evidence, "TRACE_ROWS", 100)
    assert _all_depths(evidence.trace_depth(spans)) == want and written


def test_trace_depth_in_tasks_as_by_joins(spark, monkeypatch):
    """Repeated spans, missing parents, null ids, ids that are hex and such that only look like it: the same rows both ways."""
    import random

    rng = random.Random(5)
    rows = [("ab12", "00ff", None), ("ab12", "00ff", None), ("ab12", "0abc", "00ff"), ("ab12", "0abc", "00ff"), ("ab12", "abc", "0abc"), ("ab12", "ABCD", "abc"),
            (None, "00ff", None), (None, "0abc", "00ff"), ("AB12", "x", "00ff"), ("", "", None), ("", "y", ""), ("é", "z", "é"), ("n", None, None), ("n", "c", None), ("n", None, "c"), ("n", "d", "none")]
    for t in range(60):
        ids = [f"{t}-{i}" for i in range(rng.randrange(1, 25))]
        for i, x in enumerate(ids):
            for _ in range(rng.choice((1, 1, 1, 2))):
                rows.append((f"t{t}", x, rng.choice(ids[:i] or [None])))
    rows += [("loop", "a", "b"), ("loop", "b", "a"), ("loop", "c", "b"), ("loop", "r", None), ("loop", "s", "r")]
    spans = spark.createDataFrame(rows, SPAN).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")   # traces run over batches
    try:
        got = _all_depths(evidence.trace_depth(spans))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _all_depths(evidence._depth_by_joins(spans))
    monkeypatch.setattr(evidence, "TRACE_ROWS", 0)
    assert got == _all_depths(evidence.trace_depth(spans))


def test_repeated_spans_on_a_cycle_end(spark):
    rows = [("t", "a", "b"), ("t", "b", "a"), ("t", "b", "a"), ("t", "c", "b"), ("t", "r", None), ("t", "s", "r"), ("t", "s", None), ("t", "u", "s")]
    got = _all_depths(evidence.trace_depth(spark.createDataFrame(rows, SPAN)))
    assert got == sorted([("t", "a", None), ("t", "b", None), ("t", "b", None), ("t", "c", None), ("t", "r", 0), ("t", "s", 1), ("t", "s", 0), ("t", "u", 1), ("t", "u", 2)], key=str)
