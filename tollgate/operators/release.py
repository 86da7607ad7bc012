"""Release decisions: performance budget, release policy, admission fan-in, canary analysis,
queue and shard roll-ups, deadlines, asset partitions, backfill selection, drills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.functions.guards import bounded_broadcast
from tollgate.functions.ranking import prefix_rank

# Release-control policy (burn limits 2.0 / 8.0, error 0.05, p95 50 ms, queue 0.80).
POLICY = {"burn_ok": 2.0, "burn_rollback": 8.0, "error_rollback": 0.05, "p95_ms": 50.0, "queue_pressure": 0.80,
          "availability_slo": 0.995}
CRITICAL_PRIORITY = 900
ATTESTATION_ACTION = "actions/attest@v4"


def performance_budget(observed: DataFrame, budgets: DataFrame, by: Sequence[str]) -> DataFrame:
    """(entity, metric, observed) x budgets (metric, budget, lower_is_better) -> pass, margin and the entity's action.

    Every entity is held against every budget; a metric without evidence fails, and one failure freezes the release."""
    spine = observed.select(*by).distinct().crossJoin(bounded_broadcast(budgets, 1_000, "performance budgets"))
    j = spine.join(observed, [*by, "metric"], "left")
    lower, o, b = F.col("lower_is_better"), F.col("observed"), F.col("budget")
    checks = j.select(*by, "metric", F.round(o, 4).alias("observed"), "budget",
                      F.coalesce(F.when(lower, o <= b).otherwise(o >= b), F.lit(False)).alias("passed"),
                      F.round(F.when(lower, b - o).otherwise(o - b), 4).alias("margin"))
    all_passed = F.bool_and("passed").over(Window.partitionBy(*by))     # one row for each budget
    return checks.withColumn("recommended_action", F.when(all_passed, "allow_release").otherwise("freeze_release_and_open_performance_incident"))


def queue_pressure(queued: Column, slots: Column) -> Column:
    return F.round(queued / F.greatest(queued + slots, F.lit(1)), 4)


def release_policy(df: DataFrame) -> DataFrame:
    """Five checks; rollback if burn >= 8 or error >= .05; advance if all pass; else hold.

    Input columns: gates_passed, drift_passed, latency_p95, error_rate, queued_jobs, available_slots.
    """
    burn = F.round(F.col("error_rate") / max(1 - POLICY["availability_slo"], 1e-4), 4)
    pressure = queue_pressure(F.col("queued_jobs"), F.col("available_slots"))
    d = df.withColumn("burn_rate", burn).withColumn("queue_pressure", pressure)
    # A version without traffic has no latency and no error rate: both checks fail, and it is held.
    checks = F.coalesce(F.coalesce(F.col("gates_passed"), F.lit(False)) & F.coalesce(F.col("drift_passed"), F.lit(True))
                        & (F.col("latency_p95") <= POLICY["p95_ms"]) & (F.col("burn_rate") <= POLICY["burn_ok"])
                        & (F.col("queue_pressure") <= POLICY["queue_pressure"]), F.lit(False))
    action = (F.when((F.col("burn_rate") >= POLICY["burn_rollback"]) | (F.col("error_rate") >= POLICY["error_rollback"]),
                     "rollback").when(checks, "advance_canary").otherwise("hold"))
    return d.withColumn("all_checks_passed", checks).withColumn("action", action)


def release_admission(spine: DataFrame, key: str, slo: DataFrame, perf: DataFrame, queue: DataFrame,
                      gov: DataFrame, supply: DataFrame, plan: DataFrame, missing_slo_fails: bool = True) -> DataFrame:
    """Left joins of six evidence tables onto the release spine; five checks; action priority
    freeze > rollback > throttle > admit > hold.  Missing evidence fails its check
    (``missing_slo_fails=False`` reproduces the lenient default for a missing SLO report)."""
    j = (spine.join(slo, key, "left").join(perf, key, "left").join(queue, key, "left")
              .join(gov, key, "left").join(supply, key, "left").join(plan, key, "left"))
    burn = F.coalesce(F.col("max_burn_rate"), F.lit(None if missing_slo_fails else 0.0).cast("double"))
    freeze = F.coalesce(F.col("release_freeze"), F.lit(False))
    slo_ok = F.coalesce(~freeze & (burn < 6.0), F.lit(not missing_slo_fails))
    perf_ok = F.coalesce(F.col("performance_passed"), F.lit(False))
    crit = F.coalesce(F.col("critical_pending"), F.lit(0))
    qpass = F.coalesce(F.col("queue_passed"), F.lit(False))
    queue_ok = qpass & (crit == 0)
    gov_ok = F.coalesce(F.col("governance_decision"), F.lit("unknown")) == "approved_for_champion"
    att_ok = (F.coalesce(F.col("artifact_count"), F.lit(0)) > 0) & \
        F.coalesce(F.col("attestation_action") == ATTESTATION_ACTION, F.lit(False))
    all_ok = slo_ok & perf_ok & queue_ok & gov_ok & att_ok
    plan_action = F.coalesce(F.col("release_action"), F.lit("unknown"))
    action = (F.when(freeze | F.coalesce(burn >= 14.4, F.lit(False)), "freeze_promotion")
               .when(plan_action == "rollback", "rollback_champion")
               .when(~qpass | (crit > 0), "throttle_release_queue")
               .when(all_ok, "admit_canary").otherwise("hold_canary"))
    return j.select(key, slo_ok.alias("slo_ok"), perf_ok.alias("performance_ok"), queue_ok.alias("queue_ok"),
                    gov_ok.alias("governance_ok"), att_ok.alias("attestation_ok"), action.alias("recommended_action"),
                    (action == "admit_canary").alias("admitted"),
                    ((action == "admit_canary") & ~all_ok).alias("unsafe_allow"))


def canary_analysis(log: DataFrame, by: Sequence[str], ts: str, ok: Column, interval: str = "2 minutes",
                    count: int = 3, failure_limit: int = 1) -> DataFrame:
    """Per interval a measurement (ok / failed); the last ``count`` measurements
    per entity decide: failures > limit -> abort, else promote.

    ``row_number() <= count`` gets a partial window-group limit before the shuffle.
    """
    m = log.groupBy(*by, F.window(F.col(ts).cast("timestamp"), interval).alias("w")).agg(
        F.bool_and(ok).alias("measurement_ok"))
    w = Window.partitionBy(*by).orderBy(F.col("w.start").desc())
    last = m.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= count)
    g = last.groupBy(*by).agg(F.count(F.lit(1)).alias("measurements"),
                              F.count_if(~F.col("measurement_ok")).alias("failures"))
    return g.withColumn("decision", F.when(F.col("failures") > failure_limit, "abort").otherwise("promote"))


def queue_decision_rollup(log: DataFrame, quotas: DataFrame | None = None, queue: str = "cluster_queue",
                          cpu: str = "requested_cpu") -> DataFrame:
    """admitted/pending/preempted, critical pending (priority >= 900), pressure, passed.

    Pressure = CPU held by admitted workloads / the queue's CPU quota.  Quotas
    are a (queue, cpu_quota) table; without one, a queue's quota is the CPU
    it was asked for (pressure = admitted share of demand).
    """
    s = F.col("status")
    g = log.groupBy(queue).agg(
        F.count_if(s == "admitted").alias("admitted"), F.count_if(s == "pending").alias("pending"),
        F.count_if(s == "preempted").alias("preempted"),
        F.count_if((s == "pending") & (F.col("priority") >= CRITICAL_PRIORITY)).alias("critical_pending"),
        F.sum(F.when(s == "admitted", F.col(cpu)).otherwise(0.0)).alias("_used"),
        F.sum(F.col(cpu)).alias("_asked"))
    if quotas is not None:
        g = g.join(bounded_broadcast(quotas, 100_000, "queue quotas"), queue, "left")
        quota = F.coalesce(F.col("cpu_quota"), F.col("_asked"))
    else:
        quota = F.col("_asked")
    return g.select(queue, "admitted", "pending", "preempted", "critical_pending",
                    F.round(F.col("_used") / F.greatest(quota, F.lit(1e-4)), 4).alias("pressure"),
                    (F.col("critical_pending") == 0).alias("passed"))


def pending_triage(log: DataFrame, now: Column) -> DataFrame:
    """Pending workloads by (cluster queue, local queue): count, wait, best position, requested.

    Queue position (priority desc, submitted asc, workload) is a global rank per
    cluster queue -- computed with the skew-safe ``prefix_rank`` (a few queues
    hold everything, so a plain window per queue would be one task each).
    """
    p = log.filter(F.col("status") == "pending").select(
        "cluster_queue", "local_queue", "workload", "submitted", "requested_cpu",
        (-F.col("priority")).alias("_neg_priority"))
    ranked = prefix_rank(p, ["cluster_queue"], ["_neg_priority", "submitted", "workload"], totals=False)
    wait_days = F.datediff(now, F.col("submitted"))
    return ranked.groupBy("cluster_queue", "local_queue").agg(
        F.count(F.lit(1)).alias("pending"), F.min("cum").alias("best_position"),
        F.max(wait_days).alias("max_wait_days"), F.round(F.sum("requested_cpu"), 2).alias("requested_cpu"))


def deadline_miss(starts: DataFrame, first_done: DataFrame, key: str, queued: str, started: str,
                  limit_days: int) -> DataFrame:
    """Event A (queued) -> first event B (started) later than the limit, or never."""
    j = starts.join(first_done, key, "left")
    late = F.datediff(F.col(started), F.col(queued)) > limit_days
    status = F.when(F.col(started).isNull(), "never_started").when(late, "missed").otherwise("met")
    return j.withColumn("status", status)


def deadline_policies(events: DataFrame, policies: DataFrame) -> DataFrame:
    """Events (id, key, ts, event) against policies (policy, a, b, limit_s, severity): is each ``a`` followed by a ``b`` of its key in time?

    Time is cut into slots of the policy's own limit, so the first ``b`` in time lies in the slot of ``a`` or the next one: a window
    inside of (policy, key, slot), and one equi-join with each slot's first ``b``.  A hot key is as many groups as it has slots.
    Status: met; missed (not in time); open (the deadline is later than the newest event).  a and b of a policy differ; a null key or time waits for nothing and has no row."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    e = events.filter(F.col("key").isNotNull() & F.col("ts").isNotNull()).withColumn("t", micros)
    both = e.join(bounded_broadcast(policies, 1_000, "deadline policies"), (F.col("event") == F.col("a")) | (F.col("event") == F.col("b")))
    both = both.withColumn("limit", F.col("limit_s") * F.lit(1_000_000).cast("long")).withColumn("slot", F.floor(F.col("t") / F.col("limit")))
    awaited = F.when(F.col("event") == F.col("b"), F.col("t"))
    in_slot = Window.partitionBy("policy", "key", "slot").orderBy("t").rangeBetween(0, Window.unboundedFollowing)
    waiting = both.withColumn("done", F.min(awaited).over(in_slot)).filter(F.col("event") == F.col("a"))
    later = (both.filter(F.col("event") == F.col("b")).groupBy("policy", "key", (F.col("slot") - 1).alias("slot")).agg(F.min("t").alias("next_done")))
    newest = e.agg(F.max("t").alias("newest"))                          # one row
    j = waiting.join(later, ["policy", "key", "slot"], "left").crossJoin(F.broadcast(newest))
    due = F.col("t") + F.col("limit")
    status = F.when(F.coalesce("done", "next_done") <= due, "met").when(due <= F.col("newest"), "missed").otherwise("open")
    return j.select("policy", "severity", "id", "key", "ts", status.alias("status"))


def asset_expression(events: DataFrame, partition: str = "partition_key") -> DataFrame:
    """A partition fires when (raw and candidate) or rollback_request."""
    g = events.groupBy(partition).agg(
        F.bool_or(F.col("asset") == "raw").alias("has_raw"),
        F.bool_or(F.col("asset") == "candidate").alias("has_candidate"),
        F.bool_or(F.col("asset") == "rollback_request").alias("has_rollback"))
    return g.withColumn("fires", (F.col("has_raw") & F.col("has_candidate")) | F.col("has_rollback"))


def partition_align(events: DataFrame, required: Sequence[str], partition: str = "partition_key") -> DataFrame:
    """Partitions where every required asset materialised."""
    return (events.filter(F.col("asset").isin(*required)).groupBy(partition)
                  .agg(F.count_distinct("asset").alias("assets"))
                  .withColumn("ready", F.col("assets") == len(required)))


def shard_outcome(attempts: DataFrame) -> DataFrame:
    """Indexed job roll-up: exit 42 fails the index, 78/126 fail the job, disruption ignored,
    success when min(10, indexes) indexes succeed, failure above 2 failed indexes."""
    code = F.col("exit_code")
    per_idx = attempts.groupBy("job", "idx").agg(
        F.max_by("exit_code", "attempt").alias("last_code"),
        F.bool_or(code == "42").alias("idx_failed"),
        F.bool_or(code.isin("78", "126")).alias("job_fail_code"),
        F.count_if(code != "DisruptionTarget").alias("counted_attempts"))
    g = per_idx.groupBy("job").agg(
        F.count(F.lit(1)).alias("indexes"),
        F.count_if((F.col("last_code") == "0") & ~F.col("idx_failed")).alias("succeeded"),
        F.count_if("idx_failed").alias("failed_indexes"),
        F.bool_or("job_fail_code").alias("fail_job"),
        F.max(F.greatest(F.col("counted_attempts") - 1, F.lit(0))).alias("max_retries"))
    status = (F.when(F.col("fail_job"), "failed_exit_code").when(F.col("failed_indexes") > 2, "failed_max_indexes")
               .when(F.col("succeeded") >= F.least(F.lit(10), F.col("indexes")), "succeeded").otherwise("incomplete"))
    return g.withColumn("status", status)


def drill_rollup(drills: DataFrame, by: Sequence[str], passed: str = "passed",
                 recovery: str = "recovery_s") -> DataFrame:
    """Drill scenarios per platform: count, all passed, worst recovery time."""
    return drills.groupBy(*by).agg(F.count(F.lit(1)).alias("scenarios"), F.bool_and(passed).alias("passed"),
                                   F.max(recovery).alias("max_recovery_s"))
