"""Queries of the release (R5-R16) and registry / evidence / trace (E1-E13) families."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from tollgate.functions.guards import bounded_broadcast
from tollgate.functions.ranking import nearest_rank_percentiles
from tollgate.operators import evaluate as ev
from tollgate.operators import evidence as evd
from tollgate.operators import registry as reg
from tollgate.operators import model as mdl
from tollgate.operators import release as rel
from tollgate.plans.catalog import query
from tollgate.plans.lifecycle import _M7_SQL
from tollgate.plans.sqlviews import rnd, with_views
from tollgate.sources import bindings as b
from tollgate.sources.tables import table

REPORT_DATE = _dt.date(2001, 1, 1)


def _nr(col: str, p: float) -> str:
    return rnd(f"list_sort(list({col}))[least(CAST(round_even((count(*) - 1) * {p}, 0) AS BIGINT), "
               f"count(*) - 1) + 1]", 4)


# ---- R5 ---------------------------------------------------------------------
# Performance budgets (metric, budget, lower_is_better).
PERF_BUDGETS = [("online_inference_p95_ms", 50.0, True), ("online_inference_p99_ms", 120.0, True),
                ("error_rate", 0.05, True), ("daily_requests", 50.0, False),
                ("queue_wait_p95_days", 60.0, True), ("validation_accuracy", 0.70, False)]


def _perf_budget_sql() -> str:
    rows = ", ".join(f"('{m}', CAST({v!r} AS DOUBLE), {str(lb).lower()})" for m, v, lb in PERF_BUDGETS)
    wait = f"{_nr('w', 0.95)}"
    return f"""
WITH o AS (
  SELECT service, {_nr('latency_ms', 0.95)} AS p95, {_nr('latency_ms', 0.99)} AS p99,
         avg(CAST(status <> 'success' AS DOUBLE)) AS err, count(*) / count(DISTINCT CAST(ts AS DATE)) AS daily
  FROM prediction_log GROUP BY service),
q AS (SELECT 'svc' || CAST(o_custkey % 5 AS VARCHAR) AS service, {wait} AS wait FROM (
        SELECT o_custkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(s AS DATE)) AS DOUBLE) AS w
        FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey) GROUP BY 1),
a AS (SELECT avg(CAST(prediction = churned AS DOUBLE)) AS acc FROM scored WHERE split = 'validation' AND version = '2026.07.0'),
l AS (SELECT service, 'online_inference_p95_ms' AS metric, p95 AS observed FROM o
      UNION ALL SELECT service, 'online_inference_p99_ms', p99 FROM o
      UNION ALL SELECT service, 'error_rate', err FROM o
      UNION ALL SELECT service, 'daily_requests', daily FROM o
      UNION ALL SELECT service, 'queue_wait_p95_days', wait FROM q
      UNION ALL SELECT service, 'validation_accuracy', acc FROM o, a),
c AS (SELECT s.service, b.metric, {rnd('observed', 4)} AS observed, budget,
             coalesce(CASE WHEN lower_is_better THEN observed <= budget ELSE observed >= budget END, false) AS passed,
             {rnd('CASE WHEN lower_is_better THEN budget - observed ELSE observed - budget END', 4)} AS margin
      FROM (SELECT DISTINCT service FROM l) s CROSS JOIN (VALUES {rows}) b(metric, budget, lower_is_better) LEFT JOIN l ON l.service = s.service AND l.metric = b.metric)
SELECT *, CASE WHEN bool_and(passed) OVER (PARTITION BY service) THEN 'allow_release' ELSE 'freeze_release_and_open_performance_incident' END AS recommended_action FROM c"""


@query("performance_budget", with_views(_perf_budget_sql(), "prediction_log", "scored"))
def performance_budget(spark, sf):
    """Serving, release-queue and validation metrics of each service against six budgets; what has no evidence fails."""
    log = b.prediction_log(spark, sf)
    pct = nearest_rank_percentiles(log, "latency_ms", ["service"], (0.95, 0.99), ("p95", "p99"))
    other = log.groupBy("service").agg(
        F.avg((F.col("status") != "success").cast("double")).alias("err"),
        (F.count(F.lit(1)) / F.count_distinct(F.to_date("ts"))).alias("daily"))
    rows = b.churn_split(spark, sf)
    models = mdl.model_table(spark, rows.filter(F.col("split") == "train")).filter(F.col("version") == "2026.07.0")
    accuracy = (mdl.score(rows.filter(F.col("split") == "validation"), models, keep=["churned"])
                .agg(F.avg((F.col("prediction") == F.col("churned")).cast("double")).alias("acc")))
    o = pct.join(other, "service").crossJoin(bounded_broadcast(accuracy, 1, "one accuracy"))
    first = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("started"))
    waits = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(first, "o_orderkey").select(
        F.concat(F.lit("svc"), (F.col("o_custkey") % 5).cast("string")).alias("service"), F.datediff("started", "o_orderdate").cast("double").alias("wait"))
    wait = nearest_rank_percentiles(waits, "wait", ["service"], (0.95,), ("observed",)).select("service", F.lit("queue_wait_p95_days").alias("metric"), "observed")
    names = {"online_inference_p95_ms": "p95", "online_inference_p99_ms": "p99", "error_rate": "err", "daily_requests": "daily", "validation_accuracy": "acc"}
    long = o.select("service", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("observed")) for m, c in names.items()])))
    budgets = spark.createDataFrame(PERF_BUDGETS, "metric string, budget double, lower_is_better boolean")
    return rel.performance_budget(long.unionByName(wait), budgets, ["service"])


# ---- R6 ---------------------------------------------------------------------
def _r6_sql() -> str:
    from tollgate.plans.lifecycle import _D3_SQL, _M7_SQL
    return f"""
SELECT g.version, g.gates_passed, d.drift_passed, l.latency_p95, l.error_rate, q.queued_jobs, q.available_slots,
       {rnd('l.error_rate / 0.005', 4)} AS burn_rate,
       {rnd('q.queued_jobs / greatest(q.queued_jobs + q.available_slots, 1)', 4)} AS queue_pressure,
       all_ok AS all_checks_passed,
       CASE WHEN {rnd('l.error_rate / 0.005', 4)} >= 8.0 OR l.error_rate >= 0.05 THEN 'rollback'
            WHEN all_ok THEN 'advance_canary' ELSE 'hold' END AS action
FROM (SELECT version, bool_and(passed) AS gates_passed FROM ({_M7_SQL}) GROUP BY version) g
CROSS JOIN (SELECT NOT bool_or(flagged) AS drift_passed FROM ({_D3_SQL})) d
LEFT JOIN (SELECT model_version AS version, {_nr('latency_ms', 0.95)} AS latency_p95,
             avg(CAST(status <> 'success' AS DOUBLE)) AS error_rate FROM prediction_log GROUP BY 1) l USING (version)
CROSS JOIN (SELECT count(*) FILTER (WHERE status = 'pending') AS queued_jobs,
                   count(*) FILTER (WHERE status = 'admitted') AS available_slots FROM queue_log) q,
LATERAL (SELECT coalesce(g.gates_passed, false) AND coalesce(d.drift_passed, true) AND coalesce(l.latency_p95 <= 50.0, false)
                AND coalesce({rnd('l.error_rate / 0.005', 4)} <= 2.0, false)
                AND {rnd('q.queued_jobs / greatest(q.queued_jobs + q.available_slots, 1)', 4)} <= 0.8 AS all_ok)"""


@query("release_policy", with_views(_r6_sql(), "scored", "churn_base", "prediction_log", "churn_current",
                                    "queue_log"))
def release_policy(spark, sf):
    from tollgate.operators import monitoring as mon
    from tollgate.plans.lifecycle import _drift, gate_table
    # The gate table already holds each version's serving p95 (observed value of the latency gate).
    gates = gate_table(spark, sf).groupBy("version").agg(
        F.bool_and("passed").alias("gates_passed"),
        F.max(F.when(F.col("metric") == "latency_p95_ms", F.col("observed"))).alias("latency_p95"))
    drift = mon.drift_alert_list(_drift(spark, sf)).select(F.col("passed").alias("drift_passed"))
    log = b.prediction_log(spark, sf)
    err = log.groupBy(F.col("model_version").alias("version")).agg(
        F.avg((F.col("status") != "success").cast("double")).alias("error_rate"))
    q = b.queue_log(spark, sf).agg(F.count_if(F.col("status") == "pending").alias("queued_jobs"),
                                   F.count_if(F.col("status") == "admitted").alias("available_slots"))
    df = (gates.crossJoin(bounded_broadcast(drift, 1, "drift verdict")).join(err, "version", "left")
               .crossJoin(bounded_broadcast(q, 1, "queue state")))
    return rel.release_policy(df).select(
        "version", "gates_passed", "drift_passed", "latency_p95", "error_rate", "queued_jobs", "available_slots",
        "burn_rate", "queue_pressure", "all_checks_passed", "action")


# ---- R7 ---------------------------------------------------------------------
def _evidence(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_o"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_if((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")).alias("n_crit"))
    burn = F.round(F.abs(F.col("c_acctbal")) % 20, 4)
    # Evidence exists only where the data supports it (no id subsets): SLO and
    # supply-chain reports for customers with orders, performance for customers
    # with finished or open orders, queue state for customers with open or urgent
    # orders, governance outside AUTOMOBILE, release plans above a balance floor.
    withc = per.join(c, "c_custkey", "inner")
    slo = withc.select("c_custkey", burn.alias("max_burn_rate"), (burn >= 14.4).alias("release_freeze"))
    perf = per.filter((F.col("n_f") + F.col("n_o")) > 0).select(
        "c_custkey", (F.col("n_f") >= F.col("n_o")).alias("performance_passed"))
    queue = per.filter((F.col("n_o") > 0) | (F.col("n_urgent") > 0)).select(
        "c_custkey", (F.col("n_urgent") < 3).alias("queue_passed"), F.col("n_crit").alias("critical_pending"))
    gov = c.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, "approved_for_champion").otherwise("rejected")
        .alias("governance_decision"))
    supply = withc.filter(F.col("c_mktsegment") != "FURNITURE").select(
        "c_custkey", F.col("n_orders").alias("artifact_count"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", rel.ATTESTATION_ACTION).otherwise("none").alias("attestation_action"))
    plan = c.filter(F.col("c_acctbal") > -900).select(
        "c_custkey", F.when(F.col("c_acctbal") < -500, "rollback").otherwise("advance_canary").alias("release_action"))
    return c.select("c_custkey"), slo, perf, queue, gov, supply, plan


_R7_SQL = """
WITH per AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
                    count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o,
                    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
                    count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') AS n_crit
             FROM orders GROUP BY 1),
j AS (
  SELECT c.c_custkey,
         CASE WHEN p.n_orders IS NOT NULL THEN CAST(round(CAST(CAST(abs(c.c_acctbal) % 20 AS VARCHAR) AS DECIMAL(38,18)), 4) AS DOUBLE) END AS burn,
         CASE WHEN p.n_f + p.n_o > 0 THEN p.n_f >= p.n_o END AS perf,
         CASE WHEN p.n_o > 0 OR p.n_urgent > 0 THEN p.n_urgent < 3 END AS qpass,
         CASE WHEN p.n_o > 0 OR p.n_urgent > 0 THEN p.n_crit END AS crit,
         CASE WHEN c.c_mktsegment <> 'AUTOMOBILE' THEN CASE WHEN c.c_acctbal > 0 THEN 'approved_for_champion' ELSE 'rejected' END END AS gov,
         CASE WHEN p.n_orders IS NOT NULL AND c.c_mktsegment <> 'FURNITURE' THEN p.n_orders END AS artifacts,
         CASE WHEN p.n_orders IS NOT NULL AND c.c_mktsegment <> 'FURNITURE' THEN CASE WHEN c.c_mktsegment <> 'HOUSEHOLD' THEN 'actions/attest@v4' ELSE 'none' END END AS att,
         CASE WHEN c.c_acctbal > -900 THEN CASE WHEN c.c_acctbal < -500 THEN 'rollback' ELSE 'advance_canary' END END AS plan_action
  FROM customer c LEFT JOIN per p USING (c_custkey)),
k AS (
  SELECT c_custkey, burn, coalesce(burn >= 14.4, false) AS is_frozen,
         coalesce(NOT coalesce(burn >= 14.4, false) AND burn < 6.0, false) AS slo_ok,
         coalesce(perf, false) AS performance_ok,
         coalesce(qpass, false) AS qp, coalesce(crit, 0) AS cr,
         coalesce(gov, 'unknown') = 'approved_for_champion' AS governance_ok,
         coalesce(artifacts, 0) > 0 AND coalesce(att = 'actions/attest@v4', false) AS attestation_ok,
         coalesce(plan_action, 'unknown') AS plan_action FROM j),
a AS (
  SELECT *, qp AND cr = 0 AS queue_ok,
         slo_ok AND performance_ok AND qp AND cr = 0 AND governance_ok AND attestation_ok AS all_ok,
         CASE WHEN is_frozen OR coalesce(burn >= 14.4, false) THEN 'freeze_promotion'
              WHEN plan_action = 'rollback' THEN 'rollback_champion'
              WHEN NOT qp OR cr > 0 THEN 'throttle_release_queue'
              WHEN slo_ok AND performance_ok AND qp AND cr = 0 AND governance_ok AND attestation_ok THEN 'admit_canary'
              ELSE 'hold_canary' END AS recommended_action FROM k)
SELECT c_custkey, slo_ok, performance_ok, queue_ok, governance_ok, attestation_ok, recommended_action,
       recommended_action = 'admit_canary' AS admitted, recommended_action = 'admit_canary' AND NOT all_ok AS unsafe_allow
FROM a"""


@query("release_admission", _R7_SQL)
def release_admission(spark, sf):
    return rel.release_admission(*((lambda t: (t[0], "c_custkey", *t[1:]))(_evidence(spark, sf))))


@query("optional_source", """
SELECT c.c_custkey, coalesce(s.burn, 0.0) AS max_burn_rate, s.burn IS NOT NULL AS evidence_present
FROM customer c LEFT JOIN (SELECT c_custkey, CAST(round(CAST(CAST(abs(c_acctbal) % 20 AS VARCHAR) AS DECIMAL(38,18)), 4)
                           AS DOUBLE) AS burn FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) s
USING (c_custkey)""")
def optional_source(spark, sf):
    """Read evidence when present, else a default: left join from the expected keys + coalesce."""
    spine, slo, *_ = _evidence(spark, sf)
    j = spine.join(slo, "c_custkey", "left")
    return j.select("c_custkey", F.coalesce(F.col("max_burn_rate"), F.lit(0.0)).alias("max_burn_rate"),
                    F.col("max_burn_rate").isNotNull().alias("evidence_present"))


# ---- R8 / R9 / R10 / R11 ----------------------------------------------------
@query("canary_analysis", with_views(
    "SELECT service, count(*) AS measurements, count(*) FILTER (WHERE NOT ok) AS failures, "
    "CASE WHEN count(*) FILTER (WHERE NOT ok) > 1 THEN 'abort' ELSE 'promote' END AS decision FROM ("
    "SELECT *, row_number() OVER (PARTITION BY service ORDER BY w DESC) AS r FROM ("
    "SELECT service, time_bucket(INTERVAL 2 MINUTES, ts) AS w, bool_and(latency_ms < 75.0) AS ok "
    "FROM prediction_log GROUP BY ALL)) WHERE r <= 3 GROUP BY service", "prediction_log"))
def canary_analysis(spark, sf):
    log = b.prediction_log(spark, sf)
    return rel.canary_analysis(log, ["service"], "ts", F.col("latency_ms") < 75.0)


_ADMITTED_SHARE = ("sum(CASE WHEN status = 'admitted' THEN requested_cpu ELSE 0.0 END)"
                   " / greatest(sum(requested_cpu), 1e-4)")


@query("queue_decision_rollup", with_views(
    "SELECT cluster_queue, count(*) FILTER (WHERE status = 'admitted') AS admitted, "
    "count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'preempted') AS preempted, "
    "count(*) FILTER (WHERE status = 'pending' AND priority >= 900) AS critical_pending, "
    f"{rnd(_ADMITTED_SHARE, 4)} AS pressure, "
    "count(*) FILTER (WHERE status = 'pending' AND priority >= 900) = 0 AS passed FROM queue_log GROUP BY cluster_queue",
    "queue_log"))
def queue_decision_rollup(spark, sf):
    return rel.queue_decision_rollup(b.queue_log(spark, sf))


@query("pending_triage", with_views(
    "SELECT cluster_queue, local_queue, count(*) AS pending, min(pos) AS best_position, "
    "CAST(max(date_diff('day', CAST(submitted AS DATE), DATE '2001-01-01')) AS INTEGER) AS max_wait_days, "
    f"{rnd('sum(requested_cpu)', 2)} AS requested_cpu FROM ("
    "SELECT *, row_number() OVER (PARTITION BY cluster_queue ORDER BY -priority, submitted, workload) AS pos "
    "FROM queue_log WHERE status = 'pending') GROUP BY cluster_queue, local_queue", "queue_log"))
def pending_triage(spark, sf):
    return rel.pending_triage(b.queue_log(spark, sf), F.lit(REPORT_DATE))


# Deadline policy (orders must start shipping within 30 days; severity by priority).
DEADLINE_DAYS = 30


@query("deadline_miss", f"""
SELECT o_orderpriority, status, count(*) AS orders,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'critical' WHEN o_orderpriority = '2-HIGH' THEN 'high'
            ELSE 'warning' END AS severity FROM (
  SELECT o_orderpriority, CASE WHEN s IS NULL THEN 'never_started'
                              WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(s AS DATE)) > {DEADLINE_DAYS} THEN 'missed'
                              ELSE 'met' END AS status
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)
GROUP BY ALL""")
def deadline_miss(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    first = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.min("l_shipdate").alias("started")))
    d = rel.deadline_miss(o, first, "o_orderkey", "o_orderdate", "started", DEADLINE_DAYS)
    sev = (F.when(F.col("o_orderpriority") == "1-URGENT", "critical")
            .when(F.col("o_orderpriority") == "2-HIGH", "high").otherwise("warning"))
    return d.groupBy("o_orderpriority", "status").agg(F.count(F.lit(1)).alias("orders")).withColumn("severity", sev)


# Deadline policies (policy, event, awaited event, seconds, severity): 10 minutes, 2 hours, 20 and 15 minutes.
DEADLINE_POLICIES = [("queue_to_start", "view", "click", 600, "page"), ("training_to_candidate", "click", "purchase", 7200, "ticket"),
                     ("canary_readiness", "signup", "view", 1200, "page"), ("rollback_execution", "error", "view", 900, "page")]


@query("deadline_policies", f"""
WITH p(policy, a, b, limit_s, severity) AS (VALUES {", ".join(str(x) for x in DEADLINE_POLICIES)}),
w AS (SELECT policy, severity, limit_s, e.event_id, e.ts, (SELECT min(f.ts) FROM events f WHERE f.user_id = e.user_id AND f.event_type = p.b AND f.ts >= e.ts) AS done
      FROM events e JOIN p ON e.event_type = p.a),
s AS (SELECT policy, severity, CASE WHEN done <= ts + to_seconds(limit_s) THEN 'met'
                                    WHEN ts + to_seconds(limit_s) <= (SELECT max(ts) FROM events) THEN 'missed' ELSE 'open' END AS status FROM w)
SELECT policy, severity, status, count(*) AS events FROM s GROUP BY ALL""")
def deadline_policies(spark, sf):
    """Events that wait for another of the same user, each policy with its own interval and severity."""
    policies = spark.createDataFrame(DEADLINE_POLICIES, "policy string, a string, b string, limit_s int, severity string")
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("key"), "ts", F.col("event_type").alias("event"))
    return rel.deadline_policies(e, policies).groupBy("policy", "severity", "status").agg(F.count(F.lit(1)).alias("events"))


# ---- R12 / R13 / R14 --------------------------------------------------------
@query("asset_expression", with_views(
    "SELECT partition_key, bool_or(asset = 'raw') AS has_raw, bool_or(asset = 'candidate') AS has_candidate, "
    "bool_or(asset = 'rollback_request') AS has_rollback, (bool_or(asset = 'raw') AND bool_or(asset = 'candidate')) "
    "OR bool_or(asset = 'rollback_request') AS fires FROM asset_events GROUP BY partition_key", "asset_events"))
def asset_expression(spark, sf):
    return rel.asset_expression(b.asset_events(spark, sf))


@query("partition_align", with_views(
    "SELECT partition_key, count(DISTINCT asset) AS assets, count(DISTINCT asset) = 3 AS ready FROM asset_events "
    "WHERE asset IN ('raw', 'candidate', 'canary') GROUP BY partition_key", "asset_events"))
def partition_align(spark, sf):
    return rel.partition_align(b.asset_events(spark, sf), ["raw", "candidate", "canary"])


@query("partition_backfill", with_views(
    "WITH r AS (SELECT partition_key, max(ts) AS src FROM asset_events WHERE asset = 'raw' GROUP BY 1), "
    "c AS (SELECT partition_key, max(ts) AS dst FROM asset_events WHERE asset = 'canary' GROUP BY 1), "
    "bf AS (SELECT partition_key, CASE WHEN c.dst IS NULL THEN 'missing' ELSE 'changed' END AS reason "
    "FROM r LEFT JOIN c USING (partition_key) WHERE c.dst IS NULL OR r.src > c.dst) "
    "SELECT partition_key, reason, partition_key IN (SELECT partition_key FROM bf ORDER BY partition_key DESC "
    "LIMIT 2) AS run_first FROM bf", "asset_events"))
def partition_backfill(spark, sf):
    """Partitions missing downstream or changed upstream since; latest first, two runs at a time.

    The two-run head is a top-k (TakeOrderedAndProject), the only limit, and it
    is the feature (max active backfill runs).
    """
    e = b.asset_events(spark, sf)
    src = e.filter(F.col("asset") == "raw").groupBy("partition_key").agg(F.max("ts").alias("src"))
    dst = e.filter(F.col("asset") == "canary").groupBy("partition_key").agg(F.max("ts").alias("dst"))
    bf = (src.join(dst, "partition_key", "left").filter(F.col("dst").isNull() | (F.col("src") > F.col("dst")))
             .select("partition_key", F.when(F.col("dst").isNull(), "missing").otherwise("changed").alias("reason")))
    head = bf.orderBy(F.col("partition_key").desc()).limit(2).select("partition_key", F.lit(True).alias("run_first"))
    return bf.join(F.broadcast(head), "partition_key", "left").select(
        "partition_key", "reason", F.coalesce(F.col("run_first"), F.lit(False)).alias("run_first"))


# ---- R15 / R16 --------------------------------------------------------------
@query("shard_outcome", with_views("""
SELECT job, count(*) AS indexes, count(*) FILTER (WHERE last_code = '0' AND NOT idx_failed) AS succeeded,
       count(*) FILTER (WHERE idx_failed) AS failed_indexes, bool_or(job_fail) AS fail_job,
       max(greatest(counted - 1, 0)) AS max_retries,
       CASE WHEN bool_or(job_fail) THEN 'failed_exit_code' WHEN count(*) FILTER (WHERE idx_failed) > 2 THEN 'failed_max_indexes'
            WHEN count(*) FILTER (WHERE last_code = '0' AND NOT idx_failed) >= least(10, count(*)) THEN 'succeeded'
            ELSE 'incomplete' END AS status
FROM (SELECT job, idx, arg_max(exit_code, attempt) AS last_code, bool_or(exit_code = '42') AS idx_failed,
             bool_or(exit_code IN ('78', '126')) AS job_fail, count(*) FILTER (WHERE exit_code <> 'DisruptionTarget') AS counted
      FROM shard_results GROUP BY job, idx) GROUP BY job""", "shard_results"))
def shard_outcome(spark, sf):
    return rel.shard_outcome(b.shard_results(spark, sf))


@query("drill_rollup", f"""
SELECT event_type AS platform, count(DISTINCT user_id) AS scenarios, bool_and(value < 200) AS passed,
       {rnd('max(value)', 2)} AS max_recovery_s FROM events GROUP BY event_type""")
def drill_rollup(spark, sf):
    """R16 over events: platform = event type, one drill scenario per user (recovered when
    every value stays under 200), worst recovery = largest value."""
    e = table(spark, sf, "events").select("event_type", "user_id", "value")
    drills = e.groupBy(F.col("event_type").alias("platform"), "user_id").agg(
        F.bool_and(F.col("value") < 200).alias("passed"), F.max("value").alias("recovery_s"))
    r = rel.drill_rollup(drills, ["platform"])
    return r.withColumn("max_recovery_s", F.round("max_recovery_s", 2))


# ---- E1 / E2 / E3 / E4 ------------------------------------------------------
@query("registry_state", with_views(
    "SELECT model, max(version) FILTER (WHERE r = 1) AS champion, max(version) FILTER (WHERE r = 2) AS previous_champion "
    "FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, version DESC) AS r FROM registry_events "
    "WHERE event = 'promote' AND gates_passed) WHERE r <= 2 GROUP BY model", "registry_events"))
def registry_state(spark, sf):
    return reg.registry_state(b.registry_events(spark, sf))


_E2_SQL = """
WITH RECURSIVE e AS (
  SELECT model, version, event, gates_passed,
         row_number() OVER (PARTITION BY model ORDER BY ts, version) AS i FROM registry_events),
fold(model, i, champion, previous_champion, pend) AS (
  SELECT DISTINCT model, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT) FROM e
  UNION ALL
  SELECT f.model, e.i,
         CASE WHEN e.event = 'promote' AND e.gates_passed THEN e.version
              WHEN e.event = 'rollback' AND f.previous_champion IS NOT NULL THEN f.previous_champion
              ELSE f.champion END,
         CASE WHEN e.event = 'promote' AND e.gates_passed THEN f.champion
              WHEN e.event = 'rollback' AND f.previous_champion IS NOT NULL THEN f.champion
              ELSE f.previous_champion END,
         CASE WHEN e.event = 'promote' AND e.gates_passed THEN 0
              WHEN e.event = 'rollback' AND f.champion IS NOT NULL THEN f.pend + 1 ELSE f.pend END
  FROM fold f JOIN e ON e.model = f.model AND e.i = f.i + 1)
SELECT f.model, n.events, f.champion, f.previous_champion,
       CASE WHEN f.champion IS NULL THEN NULL ELSE f.pend END AS trailing_rollbacks
FROM fold f JOIN (SELECT model, count(*) AS events FROM e GROUP BY model) n
  ON f.model = n.model AND f.i = n.events"""


@query("registry_rollback", with_views(_E2_SQL, "registry_events"))
def registry_rollback(spark, sf):
    return reg.registry_fold(b.registry_events(spark, sf))


@query("run_log", with_views(
    "SELECT substr(sha256('churn-risk:' || model || ':' || version || ':' || split), 1, 32) AS run_id, "
    f"'churn-risk' AS experiment_name, model, version, split, rows, accuracy, f1 FROM ("
    f"SELECT model, version, split, count(*) AS rows, {rnd('avg(CAST(prediction = churned AS DOUBLE))', 4)} AS accuracy, "
    f"{rnd('2 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / greatest(tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1), 1e-9::DOUBLE)', 4)} AS f1 "
    "FROM (SELECT *, count(*) FILTER (WHERE prediction = 1 AND churned = 1) OVER k AS tp, "
    "count(*) FILTER (WHERE prediction = 1 AND churned = 0) OVER k AS fp, "
    "count(*) FILTER (WHERE prediction = 0 AND churned <> 0) OVER k AS fn FROM scored "
    "WINDOW k AS (PARTITION BY model, version, split)) GROUP BY model, version, split, tp, fp, fn)", "scored"))
def run_log(spark, sf):
    from tollgate.plans.lifecycle import _scored
    m = ev.confusion_metrics(_scored(spark, sf)).select("model", "version", "split", "rows", "accuracy", "f1")
    return reg.run_log(m, ["model", "version", "split"], "churn-risk")


# The services the serving catalog declares.
DECLARED_SERVICES = ["svc0", "svc1", "svc2", "svc3", "svc4"]


@query("serving_health", with_views(
    "SELECT s.service, l.last IS NOT NULL AS deployed, coalesce(l.last = 'success', false) AS ready, "
    "CASE WHEN l.last IS NULL THEN 'not_deployed' WHEN l.last <> 'success' THEN 'latest_request_failed' "
    "ELSE 'Ready' END AS reason FROM (SELECT unnest(['svc0', 'svc1', 'svc2', 'svc3', 'svc4']) AS service "
    "UNION SELECT DISTINCT service FROM prediction_log) s LEFT JOIN (SELECT service, arg_max(status, (ts, request_id)) "
    "AS last FROM prediction_log GROUP BY service) l USING (service)", "prediction_log"))
def serving_health(spark, sf):
    log = b.prediction_log(spark, sf)
    expected = spark.createDataFrame([(s,) for s in DECLARED_SERVICES], "service string") \
        .unionByName(log.select("service")).distinct()
    return reg.serving_health(expected, log)


# ---- E5 / E6 ----------------------------------------------------------------
@query("evidence_reconcile", """
SELECT l.doc_id, d.doc_id IS NOT NULL AS "exists", sha256(d.text) AS sha256, CAST(strlen(d.text) AS INTEGER) AS bytes
FROM (SELECT DISTINCT doc_id FROM labels) l LEFT JOIN documents d USING (doc_id)""")
def evidence_reconcile(spark, sf):
    expected = table(spark, sf, "labels").select("doc_id").distinct()
    found = table(spark, sf, "documents").select("doc_id", "text")
    return evd.evidence_reconcile(expected, found, "doc_id", "text")


@query("governance_decision", with_views(
    "SELECT version, CASE WHEN bool_and(passed) THEN 'approved_for_champion' ELSE 'rejected' END AS decision, "
    "CASE WHEN count(*) FILTER (WHERE observed IS NULL) > 0 THEN 'needs_data' WHEN bool_and(passed) THEN 'controlled' "
    "ELSE 'blocked' END AS risk_status FROM (" + _M7_SQL
    + ") GROUP BY version", "scored", "churn_base", "prediction_log"))
def governance_decision(spark, sf):
    from tollgate.plans.lifecycle import gate_table
    return evd.governance_decision(gate_table(spark, sf), ["version"])


# ---- E7 / E8 / E11 / E12 ----------------------------------------------------
@query("trace_rollup", with_views(
    f"SELECT a.trace_id, a.span_count, a.critical_path_ms, a.root_service, l.leaf_service, l.leaves FROM ("
    f"SELECT trace_id, count(*) AS span_count, {rnd('sum(duration_ms)', 2)} AS critical_path_ms, "
    "max(service) FILTER (WHERE parent_span_id IS NULL) AS root_service FROM spans GROUP BY trace_id) a "
    "LEFT JOIN (SELECT trace_id, min(service) AS leaf_service, count(*) AS leaves FROM spans s WHERE NOT EXISTS ("
    "SELECT 1 FROM spans p WHERE p.trace_id = s.trace_id AND p.parent_span_id = s.span_id) GROUP BY trace_id) l "
    "USING (trace_id)", "spans"))
def trace_rollup(spark, sf):
    return evd.trace_rollup(b.spans(spark, sf))


@query("trace_depth", with_views(
    "WITH RECURSIVE d(trace_id, span_id, depth) AS ("
    "SELECT trace_id, span_id, 0 FROM spans WHERE parent_span_id IS NULL UNION ALL "
    "SELECT s.trace_id, s.span_id, d.depth + 1 FROM spans s JOIN d ON s.trace_id = d.trace_id "
    "AND s.parent_span_id = d.span_id) SELECT trace_id, span_id, depth FROM d", "spans"))
def trace_depth(spark, sf):
    return evd.trace_depth(b.spans(spark, sf))


def _inventory(spark, sf):
    flags = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("service")).distinct()
    return flags.select("service", F.concat(F.lit("mlops-"), F.lower("service")).alias("namespace"),
                        F.concat(F.lit("pod-"), F.col("service")).alias("pod"), F.lit("main").alias("container"))


@query("span_enrich", with_views(
    "SELECT s.trace_id, s.span_id, s.service, CASE WHEN i.service IS NULL THEN 1 ELSE 4 END AS attr_count, "
    "CASE WHEN i.service IS NULL THEN NULL ELSE 'mlops-' || lower(s.service) END AS namespace_attr "
    "FROM spans s LEFT JOIN (SELECT DISTINCT l_returnflag AS service FROM lineitem) i USING (service)", "spans"))
def span_enrich(spark, sf):
    e = evd.span_enrich(b.spans(spark, sf), _inventory(spark, sf))
    return e.select("trace_id", "span_id", "service", F.size("attributes").alias("attr_count"),
                    F.element_at("attributes", "k8s.namespace.name").alias("namespace_attr"))


@query("trace_pivot", with_views(f"""
SELECT trace_id, string_agg(service || '=' || printf('%.2f', d), ',' ORDER BY service) AS durations, CAST(count(*) AS INTEGER) AS services, CAST(sum(n) AS BIGINT) AS rows FROM (
  SELECT trace_id, service, {rnd('sum(duration_ms)', 2)} AS d, count(*) AS n FROM spans GROUP BY trace_id, service) GROUP BY trace_id""", "spans"))
def trace_pivot(spark, sf):
    """Per-trace duration by service, for whatever services the spans name."""
    p = evd.trace_pivot(b.spans(spark, sf), ["trace_id"], "service", F.col("duration_ms"))
    shown = F.transform(F.map_entries("pivot"), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.2f", e["value"])))
    return p.select("trace_id", F.array_join(shown, ",").alias("durations"), F.size("pivot").alias("services"), "rows")


#: Release, model, serving and SLO attributes of a span, with their value by event type for the twin.
PIVOT_ATTRIBUTES = {"release.version": "'2026.07.0'", "ml.model.version": "CASE WHEN event_type <> 'signup' THEN '2026.07.0' END",
                    "kserve.inferenceservice.name": "'churn-risk'", "slo.name": "CASE WHEN event_type <> 'view' THEN 'latency_p95' END"}


@query("attribute_pivot", " UNION ALL ".join(f"""
SELECT '{a}' AS attribute, event_type, string_agg(v || '=' || CAST(n AS VARCHAR), ',' ORDER BY v) AS counts FROM (
  SELECT event_type, coalesce({v}, 'unknown') AS v, count(*) AS n FROM events GROUP BY ALL) GROUP BY event_type""" for a, v in PIVOT_ATTRIBUTES.items()))
def attribute_pivot(spark, sf):
    """Rows by the values of four span attributes, per event type; an absent attribute is 'unknown'."""
    one = b.attrs(spark, sf).select("event_type", F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col("attributes")[a].alias("v")) for a in PIVOT_ATTRIBUTES])).alias("e"))
    p = evd.trace_pivot(one.select("event_type", "e.attribute", "e.v"), ["attribute", "event_type"], "v", F.lit(1), digits=0)
    shown = F.transform(F.map_entries("pivot"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("long").cast("string")))
    return p.select("attribute", "event_type", F.array_join(shown, ",").alias("counts"))


# ---- E9 / E10 ---------------------------------------------------------------
# Corpus policy rules (rule, mode, needle).
AUDIT_RULES = [
    ("license_text_present", "any", "license"), ("license_text_present", "any", "License"),
    ("no_private_keys", "none", "BEGIN RSA PRIVATE KEY"), ("no_private_keys", "none", "PRIVATE KEY-----"),
    ("contact_and_links", "all", "@"), ("contact_and_links", "all", "http"),
]


def _e9_sql() -> str:
    rows = ", ".join(f"('{r}', '{m}', '{n}')" for r, m, n in AUDIT_RULES)
    return f"""
SELECT rule, mode, CASE WHEN mode = 'any' THEN bool_or(docs > 0) WHEN mode = 'all' THEN bool_and(docs > 0)
                        ELSE NOT bool_or(docs > 0) END AS passed, CAST(sum(docs) AS BIGINT) AS matching_docs
FROM (SELECT r.rule, r.mode, r.needle, (SELECT count(*) FROM documents d WHERE contains(d.text, r.needle)) AS docs
      FROM (VALUES {rows}) r(rule, mode, needle)) GROUP BY rule, mode"""


@query("pattern_audit", _e9_sql())
def pattern_audit(spark, sf):
    return evd.pattern_audit(table(spark, sf, "documents").select("text"), AUDIT_RULES)


# Scorecard rules (rule, clause, needle); a rule passes when every clause has a hit.
SCORECARD_RULES = [
    ("mentions_license", 1, "license"), ("mentions_license", 1, "License"),
    ("has_contact", 1, "@"),
    ("links_and_contact", 1, "http"), ("links_and_contact", 2, "@"),
    ("mentions_model", 1, "model"), ("mentions_model", 1, "Model"),
    ("mentions_data", 1, "data"),
]


def _e10_sql() -> str:
    rows = ", ".join(f"('{r}', {c}, '{n}')" for r, c, n in SCORECARD_RULES)
    n_rules = len({r for r, _, _ in SCORECARD_RULES})
    return f"""
WITH hits AS (
  SELECT d.source, r.rule, r.clause, bool_or(contains(d.text, r.needle)) AS hit
  FROM documents d, (VALUES {rows}) r(rule, clause, needle) GROUP BY ALL),
rules AS (SELECT source, rule, bool_and(ok) AS ok FROM (
            SELECT source, rule, clause, bool_or(hit) AS ok FROM hits GROUP BY ALL) GROUP BY ALL),
lines AS (SELECT source, CAST(max(len(string_split(text, chr(10)))) AS INTEGER) AS max_lines FROM documents GROUP BY source)
SELECT source, CAST(count(*) FILTER (WHERE ok) AS INTEGER) AS rules_passed, {n_rules} AS rules,
       {rnd(f'100.0 * count(*) FILTER (WHERE ok) / {n_rules}', 2)} AS score_pct, max_lines, max_lines >= 120 AS long_enough
FROM rules JOIN lines USING (source) GROUP BY source, max_lines"""


@query("corpus_scorecard", _e10_sql())
def corpus_scorecard(spark, sf):
    return evd.corpus_scorecard(table(spark, sf, "documents").select("source", "text"), SCORECARD_RULES, "source")


# ---- E13 --------------------------------------------------------------------
@query("model_card", with_views(f"""
SELECT v.model, v.version, 'tenure_months,monthly_spend,support_tickets,late_payments,usage_drop_pct' AS features,
       t.train_rows, v.validation_accuracy, s.test_segment_accuracy
FROM (SELECT model, version, {rnd('avg(CAST(prediction = churned AS DOUBLE))', 4)} AS validation_accuracy
      FROM scored WHERE split = 'validation' GROUP BY ALL) v
CROSS JOIN (SELECT count(*) AS train_rows FROM churn_split WHERE split = 'train') t
JOIN (SELECT model, version, string_agg(segment || '=' || CAST(acc AS VARCHAR), ',' ORDER BY segment) AS test_segment_accuracy
      FROM (SELECT model, version, segment, {rnd("avg(CAST(prediction = churned AS DOUBLE))", 4)} AS acc
            FROM scored WHERE split = 'test' GROUP BY ALL) GROUP BY model, version) s USING (model, version)""", "scored", "churn_split"))
def model_card(spark, sf):
    """One row per model version: features, train rows, validation accuracy, test accuracy of every segment found."""
    from tollgate.plans.lifecycle import _scored
    from tollgate.operators.model import FEATURES
    return evd.model_card(ev.segment_confusion(_scored(spark, sf), by=["model", "version", "split"]), FEATURES)
