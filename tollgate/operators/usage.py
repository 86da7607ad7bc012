"""Platform usage analytics: right-sizing, tenancy, fair share, quotas, health.

Every operator is a grouped aggregate plus column expressions; the per-entity
tables (workloads, tenants, devices) are produced from samples by partial
aggregation, so their size is the number of entities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.functions.exprs import floor_div, round_up
from tollgate.functions.ranking import max_gap, nearest_rank_percentiles

# Right-sizing policy.
CPU_MONTHLY_USD = 28.0
MEMORY_GIB_MONTHLY_USD = 3.5
CPU_HEADROOM, MEM_HEADROOM, LIMIT_FACTOR = 1.35, 1.20, 1.25
CPU_STEP_M, MEM_STEP_MIB = 25, 32
LOWER_BELOW, RAISE_ABOVE = 0.85, 1.15
NOISY_UTIL, LOW_PRIORITY = 0.90, "mlops-low-priority"
UTIL_FLOOR = 1e-4


def usage_profile(samples: DataFrame, key: str = "workload") -> DataFrame:
    """Cpu p95 and memory p99 (nearest rank) per workload, plus the sample count.

    Both metrics go through one ranking pass: the samples are unpivoted to
    (workload, metric, value) and ranked per (workload, metric).
    """
    long = samples.select(key, F.inline(F.array(
        F.struct(F.lit("cpu_m").alias("metric"), F.col("cpu_m").cast("double").alias("value")),
        F.struct(F.lit("mem_mib").alias("metric"), F.col("mem_mib").cast("double").alias("value")))))
    p = nearest_rank_percentiles(long, "value", [key, "metric"], (0.95, 0.99), ("p95", "p99"))
    return p.groupBy(key).agg(F.max(F.when(F.col("metric") == "cpu_m", F.col("p95"))).alias("cpu_p95_m"),
                              F.max(F.when(F.col("metric") == "mem_mib", F.col("p99"))).alias("memory_p99_mib"),
                              F.max("samples").alias("forecast_units"))


def _cost(cpu_m: Column, mem_mib: Column, replicas: Column) -> Column:
    return F.round(cpu_m / 1000 * replicas * CPU_MONTHLY_USD + mem_mib / 1024 * replicas * MEMORY_GIB_MONTHLY_USD, 2)


def _action(current: Column, recommended: Column, resource: str) -> Column:
    return (F.when(recommended < current * LOWER_BELOW, f"lower_{resource}_request")
             .when(recommended > current * RAISE_ABOVE, f"raise_{resource}_request")
             .otherwise(f"keep_{resource}_request"))


def right_size(profiles: DataFrame, key: str = "workload") -> DataFrame:
    """Recommended requests, limit, replicas, monthly cost, delta and actions per workload.

    Input columns: current_cpu_m, current_memory_mib, current_replicas, cpu_p95_m,
    memory_p99_mib, forecast_units, target_units_per_replica, min/max_replicas,
    min_cpu_m, min_memory_mib.
    """
    c = F.col
    cpu = round_up(F.greatest(c("min_cpu_m"), c("cpu_p95_m") * CPU_HEADROOM), CPU_STEP_M)
    mem = round_up(F.greatest(c("min_memory_mib"), c("memory_p99_mib") * MEM_HEADROOM), MEM_STEP_MIB)
    reps = F.least(c("max_replicas"), F.greatest(c("min_replicas"),
                                                 F.ceil(c("forecast_units") / c("target_units_per_replica"))))
    d = (profiles.withColumn("cpu_request_m", cpu).withColumn("memory_request_mib", mem)
                 .withColumn("memory_limit_mib", round_up(c("memory_request_mib") * LIMIT_FACTOR, MEM_STEP_MIB))
                 .withColumn("replicas", reps.cast("long")))
    cur = _cost(c("current_cpu_m"), c("current_memory_mib"), c("current_replicas"))
    rec = _cost(c("cpu_request_m"), c("memory_request_mib"), c("replicas"))
    return d.select(
        key, "cpu_request_m", "memory_request_mib", "memory_limit_mib", "replicas",
        cur.alias("current_cost_usd"), rec.alias("recommended_cost_usd"),
        F.round(rec - cur, 2).alias("monthly_cost_delta_usd"),
        _action(c("current_cpu_m"), c("cpu_request_m"), "cpu").alias("cpu_action"),
        _action(c("current_memory_mib"), c("memory_request_mib"), "memory").alias("memory_action"),
        F.when(c("replicas") > c("current_replicas"), "prewarm_replicas").otherwise("keep_replica_floor")
         .alias("replica_action"))


def right_size_summary(rec: DataFrame) -> DataFrame:
    """Workload count, total delta, any memory raise (needs human review)."""
    return rec.agg(F.count(F.lit(1)).alias("workload_count"),
                   F.round(F.sum("monthly_cost_delta_usd"), 2).alias("estimated_monthly_delta_usd"),
                   F.coalesce(F.bool_or(F.col("memory_action") == "raise_memory_request"), F.lit(False))
                    .alias("needs_human_review"))


def tenant_utilization(t: DataFrame) -> DataFrame:
    """C11: used/quota (floor 1e-4) per resource, breach, noisy neighbour, cohort gaps."""
    cpu = F.round(floor_div("cpu_used", "cpu_quota", UTIL_FLOOR), 4)
    mem = F.round(floor_div("memory_used_gib", "memory_quota_gib", UTIL_FLOOR), 4)
    pool = F.round(floor_div("pool_used", "pool_slots", UTIL_FLOOR), 4)
    u = t.select("tenant", "cohort", "priority_class", cpu.alias("cpu_util"), mem.alias("memory_util"),
                 pool.alias("pool_util"))
    mx = F.greatest("cpu_util", "memory_util", "pool_util")
    u = u.withColumn("max_util", mx).withColumn("hard_breach", mx > 1.0) \
         .withColumn("noisy_neighbor", (mx >= NOISY_UTIL) & (F.col("priority_class") == LOW_PRIORITY))
    gaps = u.groupBy("cohort").agg(F.round(F.max("cpu_util") - F.min("cpu_util"), 4).alias("cohort_cpu_gap"),
                                   F.round(F.max("pool_util") - F.min("pool_util"), 4).alias("cohort_pool_gap"))
    return u.join(gaps, "cohort", "left")


def fair_share(queues: DataFrame, key: str = "tenant", cohort: str = "cohort") -> DataFrame:
    """Dominant resource share = observed / max((nominal + borrowing) * weight, 1e-4), round 4,
    capacity after lending and after borrowing, and the share's rank inside each cohort.

    Input columns: weight, nominal_cpu, borrowing_limit_cpu, lending_limit_cpu, observed_cpu.
    """
    c = F.col
    drs = F.round(c("observed_cpu") / F.greatest((c("nominal_cpu") + c("borrowing_limit_cpu")) * c("weight"),
                                                  F.lit(UTIL_FLOOR)), 4)
    d = queues.select(key, cohort, c("weight").cast("double").alias("weight"), drs.alias("drs"),
                      (c("nominal_cpu") - c("lending_limit_cpu")).alias("exclusive_cpu_after_lending"),
                      (c("nominal_cpu") + c("borrowing_limit_cpu")).alias("max_cpu_after_borrowing"),
                      (c("observed_cpu") > c("nominal_cpu")).alias("borrowing"))
    return d.withColumn("share_rank", F.rank().over(Window.partitionBy(cohort).orderBy("drs")))


def map_total(m: Column) -> Column:
    """Sum of a map's values."""
    return F.aggregate(F.map_values(m), F.lit(0.0), lambda a, x: a + x)


def flavor_totals(policies: DataFrame, key: str) -> DataFrame:
    """Per queue, totals of the nominal and borrowing maps and the fallback depth
    (flavours in the fallback order minus one)."""
    return policies.select(key, F.round(map_total(F.col("nominal_quota")), 4).alias("nominal_total"),
                           F.round(map_total(F.col("borrowing_limit")), 4).alias("borrowing_total"),
                           F.greatest(F.size("flavor_order") - 1, F.lit(0)).alias("fallback_depth"))


def flavor_quota(customers: DataFrame, queue: str, flavor: str) -> DataFrame:
    """C13 over data: flavour maps per queue built from per-(queue, flavour) counts
    (one entry per flavour: bounded by the flavour set), then ``flavor_totals``."""
    per = customers.groupBy(queue, flavor).agg(F.count(F.lit(1)).cast("double").alias("n"))
    maps = per.groupBy(queue).agg(
        F.map_from_entries(F.collect_list(F.struct(flavor, "n"))).alias("nominal_quota"),
        F.map_from_entries(F.collect_list(F.struct(flavor, F.floor(F.col("n") / 2).cast("double")))).alias("borrowing_limit"))
    return flavor_totals(maps.withColumn("flavor_order", F.array_sort(F.map_keys("nominal_quota"))), queue)


def quota_alignment(workers: DataFrame, declared: DataFrame, manager: str, resource: str = "resource",
                    quota: str = "quota") -> DataFrame:
    """C14: per (manager, resource), the manager quota must equal the sum of its workers' quotas."""
    s = workers.groupBy(manager, resource).agg(F.round(F.sum(quota), 4).alias("workers_total"))
    j = s.join(declared, [manager, resource], "full_outer")
    return j.select(manager, resource, "workers_total", F.round("declared_quota", 4).alias("declared_quota"),
                    F.coalesce(F.col("workers_total") == F.round("declared_quota", 4), F.lit(False)).alias("aligned"))


def capacity_demand(workloads: DataFrame, by: Sequence[str], workers: str = "max_workers",
                    gpus_per_worker: str = "gpus_per_worker") -> DataFrame:
    """Peak worker demand and GPU demand (workers x GPUs per worker) per group."""
    return workloads.groupBy(*by).agg(F.sum(workers).cast("long").alias("max_workers"),
                                      F.sum(F.col(workers) * F.col(gpus_per_worker)).cast("long").alias("gpu_demand"))


def cache_headroom(artifacts: DataFrame, limits: DataFrame, group: str = "node_group",
                   headroom_factor: int = 3) -> DataFrame:
    """Per node group, cached model size vs storage limit (limit > 3 x total) and
    whether every artifact keeps its minimum number of copies."""
    g = artifacts.groupBy(group).agg(F.sum("model_mib").cast("long").alias("model_mib"),
                                     F.bool_and(F.col("copies") >= F.col("min_copies")).alias("copies_ok"))
    j = g.join(limits, group, "inner")
    return j.select(group, "model_mib", "limit_mib",
                    (F.col("limit_mib") > headroom_factor * F.col("model_mib")).alias("headroom_ok"), "copies_ok")


def latest_state(events: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Latest value per key by ``order`` (max_by; partial aggregation, skew-safe)."""
    return events.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def device_health(events: DataFrame) -> DataFrame:
    """C17: devices whose latest health is Unhealthy/Unknown; release-critical hold if any."""
    last = latest_state(events, "device", "health", ["ts", "event_id"])
    return last.agg(F.count(F.lit(1)).alias("devices"),
                    F.count_if(F.col("health").isin("Unhealthy", "Unknown")).alias("unhealthy_or_unknown"),
                    (F.count_if(F.col("health").isin("Unhealthy", "Unknown")) > 0).alias("release_hold"))


def max_gap_seconds(events: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    """Largest gap (seconds) between consecutive events per key (skew-safe ``max_gap``)."""
    e = events.select(key, tiebreak, F.unix_timestamp(F.col(ts).cast("timestamp")).alias("_s"))
    return max_gap(e, key, "_s", tiebreak).withColumnRenamed("max_gap", "max_lag_s")
