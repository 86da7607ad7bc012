"""Hand-worked goldens from the reference's literals (FIXTURES.md part C)."""

import math

from pyspark.sql import functions as F

from tollgate.functions.ranking import nearest_rank_percentiles, prefix_rank
from tollgate.operators import evaluate as ev
from tollgate.operators import evidence as evd
from tollgate.operators import registry as reg
from tollgate.operators import release as rel
from tollgate.operators import slo
from tollgate.operators import usage as us

PROFILES = [
    # workload, current cpu, mem, replicas, p95 cpu, p99 mem, forecast, per-replica, min/max replicas, min cpu/mem
    ("kserve-churn-predictor", 750, 1024, 3, 420.0, 620.0, 640, 180, 2, 10, 250, 384),
    ("mlflow-retraining-worker", 2000, 4096, 1, 1250.0, 2800.0, 1, 1, 1, 4, 750, 2048),
    ("drift-monitor", 500, 512, 2, 140.0, 220.0, 2, 1, 1, 4, 150, 256),
]
PROFILE_COLS = ("workload current_cpu_m current_memory_mib current_replicas cpu_p95_m memory_p99_mib "
                "forecast_units target_units_per_replica min_replicas max_replicas min_cpu_m min_memory_mib").split()


def test_right_size_goldens(spark):
    rec = us.right_size(spark.createDataFrame(PROFILES, PROFILE_COLS))
    got = {r.workload: r for r in rec.collect()}
    k = got["kserve-churn-predictor"]
    assert (k.cpu_request_m, k.memory_request_mib, k.memory_limit_mib, k.replicas) == (575, 768, 960, 4)
    assert (k.current_cost_usd, k.recommended_cost_usd, k.monthly_cost_delta_usd) == (73.5, 74.9, 1.4)
    assert (k.cpu_action, k.memory_action, k.replica_action) == (
        "lower_cpu_request", "lower_memory_request", "prewarm_replicas")
    m = got["mlflow-retraining-worker"]
    assert (m.cpu_request_m, m.memory_request_mib, m.memory_limit_mib, m.replicas) == (1700, 3360, 4224, 1)
    assert (m.recommended_cost_usd, m.monthly_cost_delta_usd, m.cpu_action) == (59.08, -10.92, "keep_cpu_request")
    d = got["drift-monitor"]
    assert (d.cpu_request_m, d.memory_request_mib, d.memory_limit_mib, d.replicas) == (200, 288, 384, 2)
    assert (d.recommended_cost_usd, d.monthly_cost_delta_usd) == (13.17, -18.33)
    s = us.right_size_summary(rec).collect()[0]
    assert (s.workload_count, s.estimated_monthly_delta_usd, s.needs_human_review) == (3, -27.85, False)


def test_tenant_utilization_and_fair_share(spark):
    rows = [("release-critical", 0, 1, 24.0, 14.0, 96.0, 44.0, 8.0, 4.0, "mlops-release-critical"),
            ("batch-scoring", 1, 1, 18.0, 12.0, 72.0, 46.0, 5.0, 3.0, "mlops-batch-normal"),
            ("experimentation", 2, 1, 10.0, 8.0, 40.0, 27.0, 2.0, 2.0, "mlops-low-priority")]
    cols = ("tenant tenant_key cohort cpu_quota cpu_used memory_quota_gib memory_used_gib pool_slots pool_used "
            "priority_class").split()
    u = {r.tenant: r for r in us.tenant_utilization(spark.createDataFrame(rows, cols)).collect()}
    assert [u[t].cpu_util for t in ("release-critical", "batch-scoring", "experimentation")] == [0.5833, 0.6667, 0.8]
    assert u["experimentation"].cohort_cpu_gap == 0.2167
    assert [u[t].pool_util for t in ("release-critical", "batch-scoring", "experimentation")] == [0.5, 0.6, 1.0]
    assert u["experimentation"].cohort_pool_gap == 0.5
    assert [t for t, r in u.items() if r.noisy_neighbor] == ["experimentation"]


def test_fair_share_goldens(spark):
    rows = [("release-critical", "c", 4.0, 24.0, 8.0, 2.0, 21.0), ("batch-scoring", "c", 2.0, 18.0, 10.0, 6.0, 20.0),
            ("experimentation", "c", 1.0, 10.0, 4.0, 8.0, 8.0)]
    q = spark.createDataFrame(rows, "tenant string, cohort string, weight double, nominal_cpu double, "
                                    "borrowing_limit_cpu double, lending_limit_cpu double, observed_cpu double")
    got = {r.tenant: r for r in us.fair_share(q).collect()}
    assert [got[t].drs for t in ("release-critical", "batch-scoring", "experimentation")] == [0.1641, 0.3571, 0.5714]
    assert got["release-critical"].exclusive_cpu_after_lending == 22.0
    assert got["batch-scoring"].max_cpu_after_borrowing == 28.0
    assert [got[t].share_rank for t in ("release-critical", "batch-scoring", "experimentation")] == [1, 2, 3]


def test_burn_rate_status(spark):
    df = spark.createDataFrame([("a", "online_inference_availability", 0.06),
                                ("b", "feature_drift_clean_window", 1.0)], "svc string, slo string, error_ratio double")
    st = {r.svc: r for r in slo.slo_status(df, slo.slo_targets(spark), ["svc"]).collect()}
    assert (st["a"].burn_rate, st["a"].status) == (12.0, "hold_release")
    assert (st["b"].burn_rate, st["b"].status) == (20.0, "page")
    act = {r.svc: r for r in slo.slo_action(slo.slo_status(df, slo.slo_targets(spark), ["svc"]), ["svc"]).collect()}
    assert act["b"].recommended_action == "freeze_promotion_and_page" and act["b"].release_freeze


def test_release_policy_goldens(spark):
    df = spark.createDataFrame([("bad", True, True, 18.0, 0.06, 1, 7), ("good", True, True, 18.0, 0.0, 1, 8)],
                               "k string, gates_passed boolean, drift_passed boolean, latency_p95 double, "
                               "error_rate double, queued_jobs int, available_slots int")
    got = {r.k: r for r in rel.release_policy(df).collect()}
    assert got["bad"].action == "rollback"
    assert got["good"].action == "advance_canary" and got["good"].queue_pressure == 0.1111


def test_nearest_rank_percentiles(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "v double")
    r = nearest_rank_percentiles(df, "v", (), (0.5, 0.95)).collect()[0]
    assert (r.p50, r.p95) == (5.0, 10.0)
    empty = nearest_rank_percentiles(df.filter("v < 0"), "v", (), (0.5,)).collect()[0]
    assert empty.p50 == 0.0


def test_prefix_rank_is_partitioning_invariant(spark):
    base = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), F.col("id"), (F.col("id") % 7).alias("w"))
    a = prefix_rank(base, ["k"], ["id"], "w").select("k", "id", "cum", "n")
    b = prefix_rank(base.repartition(13), ["k"], ["id"], "w", partitions=5).select("k", "id", "cum", "n")
    assert sorted(a.collect()) == sorted(b.collect())
    row = a.filter("k = 0 and id = 3").collect()[0]
    assert row.cum == 0 + 3 and row.n == sum(i % 7 for i in range(0, 5000, 3))


def test_failing_metrics_fail_five_gates(spark):
    m = spark.createDataFrame([("m", 1.0, 0.52, 0.18, 0.42, 0.30, 120.0)],
                              "k string, data_quality_passed double, accuracy double, f1 double, brier_score double, "
                              "segment_accuracy_gap double, latency_p95_ms double")
    long = ev.metrics_to_long(m, ["data_quality_passed", "accuracy", "f1", "brier_score", "segment_accuracy_gap",
                                  "latency_p95_ms"], ["k"])
    g = ev.evaluation_gates(long, ev.gate_policy(spark), ["k"]).collect()
    assert sum(not r.passed for r in g) == 5
    missing = ev.evaluation_gates(long.filter("metric <> 'f1'"), ev.gate_policy(spark), ["k"]).collect()
    assert [r.passed for r in missing if r.gate == "min_f1"] == [False]


def test_trace_rollup_golden(spark):
    rows = [("t", "a", None, "airflow", 1800.0), ("t", "b", "a", "metaflow", 780.0), ("t", "c", "b", "mlflow", 42.0),
            ("t", "d", "c", "kserve", 310.0), ("t", "e", "d", "prometheus", 18.0)]
    sp = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, service string, "
                                     "duration_ms double")
    r = evd.trace_rollup(sp).collect()[0]
    assert (r.span_count, r.critical_path_ms, r.root_service, r.leaf_service) == (5, 2950.0, "airflow", "prometheus")
    depth = {x.span_id: x.depth for x in evd.trace_depth(sp).collect()}
    assert depth == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4}


def test_registry_fold_sequences(spark):
    import datetime as dt
    d = lambda i: dt.datetime(2026, 7, i)
    ev_rows = [
        (1, 10, d(1), "rollback", False),                       # no champion yet: no-op
        (2, 20, d(1), "promote", True), (2, 21, d(2), "rollback", False),   # no previous: no-op
        (3, 30, d(1), "promote", True), (3, 31, d(2), "promote", True), (3, 32, d(3), "rollback", False),
        (4, 40, d(1), "promote", True), (4, 41, d(2), "promote", True), (4, 42, d(3), "rollback", False),
        (4, 43, d(4), "promote", True), (4, 44, d(5), "rollback", False), (4, 45, d(6), "rollback", False),
        (5, 50, d(1), "promote", True), (5, 51, d(2), "promote", False),  # failed gates: ignored
    ]
    e = spark.createDataFrame(ev_rows, "model long, version long, ts timestamp, event string, gates_passed boolean")
    got = {r.model: (r.champion, r.previous_champion) for r in reg.registry_fold(e).collect()}
    assert got[1] == (None, None)
    assert got[2] == (20, None)
    assert got[3] == (30, 31)
    assert got[4] == (43, 40)
    assert got[5] == (50, None)


def test_queue_rollup(spark):
    # decision log of the reference's five workloads after its preemption pass (quota 16 cpu)
    rows = [("q", "candidate-training-gpu", "admitted", 750, 8.0), ("q", "batch-scoring-validation", "admitted", 500, 4.0),
            ("q", "ad-hoc-feature-notebook", "preempted", 100, 3.0), ("q", "drift-monitor-backfill", "preempted", 450, 3.0),
            ("q", "emergency-rollback-validation", "admitted", 1000, 3.0)]
    log = spark.createDataFrame(rows, "cluster_queue string, workload string, status string, priority int, "
                                      "requested_cpu double")
    quotas = spark.createDataFrame([("q", 16.0)], "cluster_queue string, cpu_quota double")
    r = rel.queue_decision_rollup(log, quotas).collect()[0]
    assert (r.admitted, r.pending, r.preempted, r.critical_pending, r.passed) == (3, 0, 2, 0, True)
    assert r.pressure == 0.9375


def test_flavor_totals_and_quota_alignment(spark):
    pol = spark.createDataFrame(
        [("release-validation", {"cpu-on-demand": 16.0, "cpu-spot": 8.0}, {"cpu-on-demand": 4.0, "cpu-spot": 12.0},
          ["cpu-on-demand", "cpu-spot"]),
         ("batch-scoring", {"cpu-spot": 24.0, "cpu-on-demand": 6.0}, {"cpu-spot": 18.0, "cpu-on-demand": 4.0},
          ["cpu-spot", "cpu-on-demand"]),
         ("gpu-canary-analysis", {"gpu-l4-reserved": 1.0, "gpu-l4-spot": 2.0}, {"gpu-l4-reserved": 1.0, "gpu-l4-spot": 2.0},
          ["gpu-l4-reserved", "gpu-l4-spot"])],
        "name string, nominal_quota map<string,double>, borrowing_limit map<string,double>, flavor_order array<string>")
    got = {r.name: (r.nominal_total, r.borrowing_total, r.fallback_depth) for r in us.flavor_totals(pol, "name").collect()}
    assert got == {"release-validation": (24.0, 16.0, 1), "batch-scoring": (30.0, 22.0, 1),
                   "gpu-canary-analysis": (3.0, 3.0, 1)}
    workers = spark.createDataFrame(
        [("mgr", r, float(q)) for r, qs in (("cpu", (64, 48, 32)), ("memory_gib", (256, 192, 256)), ("gpu", (2, 0, 4)))
         for q in qs], "manager string, resource string, quota double")
    declared = spark.createDataFrame([("mgr", "cpu", 144.0), ("mgr", "memory_gib", 704.0), ("mgr", "gpu", 6.0)],
                                     "manager string, resource string, declared_quota double")
    al = {r.resource: (r.workers_total, r.aligned) for r in us.quota_alignment(workers, declared, "manager").collect()}
    assert al == {"cpu": (144.0, True), "memory_gib": (704.0, True), "gpu": (6.0, True)}


def test_capacity_cache_health_drills(spark):
    w = spark.createDataFrame([("p", 8, 0), ("p", 16, 1), ("p", 12, 0)], "g string, max_workers int, gpus_per_worker int")
    r = us.capacity_demand(w, ["g"]).collect()[0]
    assert (r.max_workers, r.gpu_demand) == (36, 16)
    arts = spark.createDataFrame([("n", 312, 3, 2), ("n", 304, 3, 2), ("n", 298, 2, 1)],
                                 "node_group string, model_mib int, copies int, min_copies int")
    lim = spark.createDataFrame([("n", 16 * 1024)], "node_group string, limit_mib int")
    c = us.cache_headroom(arts, lim).collect()[0]
    assert (c.model_mib, c.headroom_ok, c.copies_ok) == (914, True, True)
    import datetime as dt
    ev = spark.createDataFrame([(1, dt.datetime(2026, 7, 1), 1, "Unhealthy"), (2, dt.datetime(2026, 7, 1), 2, "Unknown"),
                                (3, dt.datetime(2026, 7, 1), 3, "Healthy")],
                               "device long, ts timestamp, event_id long, health string")
    h = us.device_health(ev).collect()[0]
    assert (h.devices, h.unhealthy_or_unknown, h.release_hold) == (3, 2, True)
    d = spark.createDataFrame([("k8s", 120, True), ("k8s", 300, True), ("k8s", 600, True)],
                              "platform string, recovery_s int, passed boolean")
    dr = rel.drill_rollup(d, ["platform"]).collect()[0]
    assert (dr.scenarios, dr.passed, dr.max_recovery_s) == (3, True, 600)
