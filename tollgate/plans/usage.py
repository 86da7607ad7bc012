"""Queries of the cost (C4-C10, T11) and usage (C1-C3, C11-C21) families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollgate.functions.guards import bounded_broadcast
from tollgate.operators import cost
from tollgate.operators import timeseries as ts
from tollgate.operators import usage as us
from tollgate.plans.catalog import query
from tollgate.plans.sqlviews import rnd, with_views
from tollgate.sources import bindings as b
from tollgate.sources.tables import table

GIB = "1073741824.0::DOUBLE"


def msum(x: str) -> str:
    return f"CAST(round(sum(CAST(({x}) AS DECIMAL(38,6))), 2) AS DOUBLE)"


# ---- T11 / C4 / C5 / C6 -----------------------------------------------------
@query("vec_join_many_to_one", with_views(
    f"SELECT namespace, node, {rnd('sum(cpu) * any_value(cpu_h)', 6)} AS value FROM alloc_samples "
    f"JOIN node_prices USING (node) GROUP BY namespace, node", "alloc_samples", "node_prices"))
def vec_join_many_to_one(spark, sf):
    s = b.alloc_samples(spark, sf).groupBy("namespace", "node").agg(F.sum("cpu").alias("value"))
    j = ts.vec_group_left(s, b.node_prices(spark, sf), ["node"], "*", one_value="cpu_h")
    return j.select("namespace", "node", F.round("value", 6).alias("value"))


_C4_SQL = (f"SELECT namespace, team, {msum('q * cpu_h * 730')} AS cpu_cost FROM ("
           "SELECT namespace, team, node, sum(cpu) AS q FROM alloc_samples GROUP BY ALL) "
           "JOIN node_prices USING (node) GROUP BY namespace, team")
_C5_SQL = (f"SELECT namespace, team, {msum(f'q * ram_h * 730 / {GIB}')} AS mem_cost FROM ("
           "SELECT namespace, team, node, sum(mem_bytes) AS q FROM alloc_samples GROUP BY ALL) "
           "JOIN node_prices USING (node) GROUP BY namespace, team")


@query("cost_cpu_monthly", with_views(_C4_SQL, "alloc_samples", "node_prices"))
def cost_cpu_monthly(spark, sf):
    return cost.cost_cpu_monthly(b.alloc_samples(spark, sf), b.node_prices(spark, sf), ["namespace", "team"])


@query("cost_mem_monthly", with_views(_C5_SQL, "alloc_samples", "node_prices"))
def cost_mem_monthly(spark, sf):
    return cost.cost_mem_monthly(b.alloc_samples(spark, sf), b.node_prices(spark, sf), ["namespace", "team"])


_C6_SQL = (f"SELECT namespace, node, {msum('gpu_h * 730')} AS gpu_cost FROM ("
           "SELECT DISTINCT namespace, node FROM alloc_samples) JOIN node_prices USING (node) "
           "WHERE gpu_h > 0 GROUP BY namespace, node")


@query("cost_gpu_monthly", with_views(_C6_SQL, "alloc_samples", "node_prices"))
def cost_gpu_monthly(spark, sf):
    return cost.cost_gpu_monthly(b.alloc_samples(spark, sf), b.node_prices(spark, sf), ["namespace"])


# ---- C7 / C8 / C9 / C10 -----------------------------------------------------
_NS_CPU = (f"SELECT namespace, {msum('q * cpu_h * 730')} AS cpu_cost FROM ("
           "SELECT namespace, node, sum(cpu) AS q FROM alloc_samples GROUP BY ALL) "
           "JOIN node_prices USING (node) GROUP BY namespace")
_NS_MEM = (f"SELECT namespace, {msum(f'q * ram_h * 730 / {GIB}')} AS mem_cost FROM ("
           "SELECT namespace, node, sum(mem_bytes) AS q FROM alloc_samples GROUP BY ALL) "
           "JOIN node_prices USING (node) GROUP BY namespace")


_tot = "CAST(round(CAST(cpu_cost AS DECIMAL(38,6)) + CAST(mem_cost AS DECIMAL(38,6)), 2) AS DOUBLE)"


@query("budget_exceeded", with_views(
    f"SELECT namespace, {_tot} AS monthly_cost, coalesce(budget, {cost.NAMESPACE_BUDGET!r}::DOUBLE) AS budget, "
    f"{_tot} > coalesce(budget, {cost.NAMESPACE_BUDGET!r}) AS exceeded "
    f"FROM ({_NS_CPU}) JOIN ({_NS_MEM}) USING (namespace) LEFT JOIN (SELECT * FROM (VALUES "
    + ", ".join(f"('ns{i}', {v!r}::DOUBLE)" for i, (_, v) in enumerate(cost.WORKLOAD_BUDGETS)) + ") v(namespace, budget)) USING (namespace)",
    "alloc_samples", "node_prices"))
def budget_exceeded(spark, sf):
    s, p = b.alloc_samples(spark, sf), b.node_prices(spark, sf)
    c = cost.cost_cpu_monthly(s, p, ["namespace"])
    m = cost.cost_mem_monthly(s, p, ["namespace"])
    # The three workloads run in the first three namespaces.
    budgets = spark.createDataFrame([(f"ns{i}", v) for i, (_, v) in enumerate(cost.WORKLOAD_BUDGETS)], "namespace string, budget double")
    return cost.budget_exceeded(c, m, budgets, ["namespace"])


@query("idle_gpu", with_views(
    f"SELECT * FROM ({_C6_SQL}) WHERE (namespace, node) NOT IN "
    f"(SELECT (namespace, node) FROM alloc_samples WHERE cpu >= 0.9)", "alloc_samples", "node_prices"))
def idle_gpu(spark, sf):
    s, p = b.alloc_samples(spark, sf), b.node_prices(spark, sf)
    g = cost.cost_gpu_monthly(s, p, ["namespace"])
    usage = s.select("namespace", "node", F.when(F.col("cpu") >= 0.9, 1.0).otherwise(0.0).alias("usage"))
    return cost.idle_gpu(g, usage, ["namespace", "node"])


@query("missing_cost_label", with_views(
    "SELECT namespace, count(*) AS pods_missing_label, count(*) > 0 AS alert FROM ("
    "SELECT DISTINCT namespace, pod FROM alloc_samples EXCEPT "
    "SELECT DISTINCT namespace, pod FROM alloc_samples WHERE cost_center IS NOT NULL AND cost_center <> '') "
    "GROUP BY namespace", "alloc_samples"))
def missing_cost_label(spark, sf):
    return cost.missing_cost_label(b.alloc_samples(spark, sf))


#: Spend of each dimension alone, of team and model together, of all seven, and in total.
SPEND_SETS = [*[(d,) for d in cost.ALLOCATION_DIMENSIONS], ("label_team", "label_model"), cost.ALLOCATION_DIMENSIONS, ()]
_DIMS = ", ".join(cost.ALLOCATION_DIMENSIONS)


@query("cost_rollup", with_views(
    f"SELECT {_DIMS}, CAST(round(sum(CAST(c AS DECIMAL(38,6))), 2) AS DOUBLE) AS spend, CAST(grouping({_DIMS}) AS INTEGER) AS grouping_id FROM ("
    f"SELECT {_DIMS}, q * CAST(cpu_h AS DECIMAL(10,6)) * 730 AS c FROM ("
    f"SELECT {_DIMS}, node, CAST(sum(CAST(cpu AS DECIMAL(18,6))) AS DECIMAL(20,6)) AS q FROM allocations GROUP BY ALL) "
    f"JOIN node_prices USING (node)) GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(x) + ')' for x in SPEND_SETS)})",
    "allocations", "node_prices"))
def cost_rollup(spark, sf):
    return cost.cost_rollup(b.allocations(spark, sf), b.node_prices(spark, sf), SPEND_SETS)


# ---- C1 / C2 / C3 -----------------------------------------------------------
def _profiles(spark, sf):
    s = b.workload_samples(spark, sf)
    prof = us.usage_profile(s)
    size = s.groupBy("workload").agg(F.max("p_size").alias("p_size"))
    return prof.join(size, "workload").select(
        "workload", "cpu_p95_m", "memory_p99_mib", "forecast_units",
        (F.col("p_size") * 50).alias("current_cpu_m"), (F.col("p_size") * 64).alias("current_memory_mib"),
        (F.lit(1) + F.col("p_size") % 4).alias("current_replicas"),
        F.lit(10).alias("target_units_per_replica"), F.lit(1).alias("min_replicas"), F.lit(10).alias("max_replicas"),
        F.lit(100).alias("min_cpu_m"), F.lit(256).alias("min_memory_mib"))


def _nr(col: str, p: float) -> str:
    return rnd(f"list_sort(list({col}))[least(CAST(round_even((count(*) - 1) * {p}, 0) AS BIGINT), "
               f"count(*) - 1) + 1]", 4)


_PROFILE_SQL = f"""
SELECT workload, {_nr('cpu_m', 0.95)} AS cpu_p95_m, {_nr('mem_mib', 0.99)} AS memory_p99_mib,
       count(*) AS forecast_units, max(p_size) * 50 AS current_cpu_m, max(p_size) * 64 AS current_memory_mib,
       1 + max(p_size) % 4 AS current_replicas
FROM workload_samples GROUP BY workload"""


def _c1_sql() -> str:
    cpu = "CAST(ceil(greatest(100, cpu_p95_m * 1.35::DOUBLE) / 25) * 25 AS BIGINT)"
    mem = "CAST(ceil(greatest(256, memory_p99_mib * 1.2::DOUBLE) / 32) * 32 AS BIGINT)"
    return f"""
SELECT workload, cpu_request_m, memory_request_mib,
       CAST(ceil(memory_request_mib * 1.25::DOUBLE / 32) * 32 AS BIGINT) AS memory_limit_mib, replicas,
       cur AS current_cost_usd, rec AS recommended_cost_usd, {rnd('rec - cur', 2)} AS monthly_cost_delta_usd,
       CASE WHEN cpu_request_m < current_cpu_m * 0.85::DOUBLE THEN 'lower_cpu_request'
            WHEN cpu_request_m > current_cpu_m * 1.15::DOUBLE THEN 'raise_cpu_request' ELSE 'keep_cpu_request' END
         AS cpu_action,
       CASE WHEN memory_request_mib < current_memory_mib * 0.85::DOUBLE THEN 'lower_memory_request'
            WHEN memory_request_mib > current_memory_mib * 1.15::DOUBLE THEN 'raise_memory_request'
            ELSE 'keep_memory_request' END AS memory_action,
       CASE WHEN replicas > current_replicas THEN 'prewarm_replicas' ELSE 'keep_replica_floor' END AS replica_action
FROM (
  SELECT *, {rnd('current_cpu_m / 1000 * current_replicas * 28.0::DOUBLE + current_memory_mib / 1024 * current_replicas * 3.5::DOUBLE', 2)} AS cur,
            {rnd('cpu_request_m / 1000 * replicas * 28.0::DOUBLE + memory_request_mib / 1024 * replicas * 3.5::DOUBLE', 2)} AS rec
  FROM (
    SELECT *, {cpu} AS cpu_request_m, {mem} AS memory_request_mib,
           CAST(least(10, greatest(1, ceil(forecast_units / 10))) AS BIGINT) AS replicas
    FROM ({_PROFILE_SQL})))"""


@query("usage_profile", with_views(
    f"SELECT workload, cpu_p95_m, memory_p99_mib, forecast_units FROM ({_PROFILE_SQL})", "workload_samples"))
def usage_profile(spark, sf):
    return us.usage_profile(b.workload_samples(spark, sf))


@query("right_size", with_views(_c1_sql(), "workload_samples"))
def right_size(spark, sf):
    return us.right_size(_profiles(spark, sf))


@query("right_size_summary", with_views(
    f"SELECT count(*) AS workload_count, {rnd('sum(monthly_cost_delta_usd)', 2)} AS estimated_monthly_delta_usd, "
    f"coalesce(bool_or(memory_action = 'raise_memory_request'), false) AS needs_human_review FROM ({_c1_sql()})",
    "workload_samples"))
def right_size_summary(spark, sf):
    return us.right_size_summary(us.right_size(_profiles(spark, sf)))


# ---- C11..C16 ---------------------------------------------------------------
_C11_SQL = f"""
WITH u AS (
  SELECT tenant, cohort, priority_class,
         {rnd('cpu_used / greatest(cpu_quota, 1e-4)', 4)} AS cpu_util,
         {rnd('memory_used_gib / greatest(memory_quota_gib, 1e-4)', 4)} AS memory_util,
         {rnd('pool_used / greatest(pool_slots, 1e-4)', 4)} AS pool_util FROM tenant_usage),
v AS (SELECT *, greatest(cpu_util, memory_util, pool_util) AS max_util FROM u)
SELECT v.*, max_util > 1.0 AS hard_breach,
       max_util >= 0.9 AND priority_class = 'mlops-low-priority' AS noisy_neighbor, g.cohort_cpu_gap, g.cohort_pool_gap
FROM v JOIN (SELECT cohort, {rnd('max(cpu_util) - min(cpu_util)', 4)} AS cohort_cpu_gap,
                    {rnd('max(pool_util) - min(pool_util)', 4)} AS cohort_pool_gap FROM u GROUP BY cohort) g
USING (cohort)"""


@query("tenant_utilization", with_views(_C11_SQL, "tenant_usage"))
def tenant_utilization(spark, sf):
    return us.tenant_utilization(b.tenant_usage(spark, sf))


@query("fair_share", with_views(
    "SELECT tenant, cohort, weight, "
    f"{rnd('observed_cpu / greatest((nominal_cpu + borrowing_limit_cpu) * weight, 1e-4)', 4)} AS drs, "
    "nominal_cpu - lending_limit_cpu AS exclusive_cpu_after_lending, "
    "nominal_cpu + borrowing_limit_cpu AS max_cpu_after_borrowing, observed_cpu > nominal_cpu AS borrowing, "
    "CAST(rank() OVER (PARTITION BY cohort ORDER BY "
    f"{rnd('observed_cpu / greatest((nominal_cpu + borrowing_limit_cpu) * weight, 1e-4)', 4)}) AS INTEGER) AS share_rank "
    "FROM (SELECT tenant, cohort, CAST(1 + tenant_key % 3 AS DOUBLE) AS weight, cpu_quota AS nominal_cpu, "
    "cpu_quota * 0.5::DOUBLE AS borrowing_limit_cpu, cpu_quota * 0.25::DOUBLE AS lending_limit_cpu, "
    "cpu_used AS observed_cpu FROM tenant_usage)", "tenant_usage"))
def fair_share(spark, sf):
    """C12 over tenants: weight 1-3 by tenant, borrowing 50 % and lending 25 % of the nominal quota."""
    t = b.tenant_usage(spark, sf)
    q = t.select("tenant", "cohort", (F.lit(1) + F.col("tenant_key") % 3).cast("double").alias("weight"),
                 F.col("cpu_quota").alias("nominal_cpu"), (F.col("cpu_quota") * 0.5).alias("borrowing_limit_cpu"),
                 (F.col("cpu_quota") * 0.25).alias("lending_limit_cpu"), F.col("cpu_used").alias("observed_cpu"))
    return us.fair_share(q)


@query("flavor_quota", """
SELECT c_nationkey, round(CAST(sum(n) AS DOUBLE), 4) AS nominal_total,
       round(CAST(sum(floor(n / 2)) AS DOUBLE), 4) AS borrowing_total,
       CAST(greatest(count(*) - 1, 0) AS INTEGER) AS fallback_depth
FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) GROUP BY c_nationkey""")
def flavor_quota(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    return us.flavor_quota(c, "c_nationkey", "c_mktsegment")


@query("quota_alignment", with_views(f"""
WITH workers AS (
  SELECT cohort, resource, {rnd('sum(quota)', 4)} AS workers_total FROM (
    SELECT cohort, 'cpu' AS resource, cpu_quota AS quota FROM tenant_usage
    UNION ALL SELECT cohort, 'pool_slots', pool_slots FROM tenant_usage) GROUP BY ALL),
declared AS (
  SELECT n_regionkey AS cohort, 'cpu' AS resource, count(*) / 10.0::DOUBLE AS d
  FROM (SELECT DISTINCT o_custkey FROM orders) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
  UNION ALL SELECT n_regionkey, 'pool_slots', CAST(count(*) AS DOUBLE)
  FROM (SELECT DISTINCT l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT coalesce(w.cohort, d.cohort) AS cohort, coalesce(w.resource, d.resource) AS resource, workers_total, {rnd('d', 4)} AS declared_quota,
       coalesce(workers_total = {rnd('d', 4)}, false) AS aligned
FROM workers w FULL JOIN declared d ON w.cohort = d.cohort AND w.resource = d.resource""", "tenant_usage"))
def quota_alignment(spark, sf):
    """C14: the manager of a region declares quota for the customers that have orders and the suppliers that ship;
    its workers, the nations, hold quota for all that are registered."""
    n = bounded_broadcast(table(spark, sf, "nation").select("n_nationkey", "n_regionkey"), 10_000, "nation")
    active = lambda fact, key: table(spark, sf, fact).select(key).distinct()
    customers = active("orders", "o_custkey").join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    suppliers = active("lineitem", "l_suppkey").join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    declare = lambda rows, key, resource, unit: (rows.join(n, F.col(key) == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("cohort"))
                                                 .agg((F.count(F.lit(1)) / unit).alias("declared_quota")).withColumn("resource", F.lit(resource)))
    declared = declare(customers, "c_nationkey", "cpu", 10.0).unionByName(declare(suppliers, "s_nationkey", "pool_slots", 1.0))
    quotas = F.array(*[F.struct(F.lit(r).alias("resource"), F.col(c).alias("quota")) for r, c in (("cpu", "cpu_quota"), ("pool_slots", "pool_slots"))])
    workers = b.tenant_usage(spark, sf).select("cohort", F.inline(quotas))
    return us.quota_alignment(workers, declared, "cohort")


@query("capacity_demand", """
SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS max_workers,
       CAST(sum(CASE WHEN p_type LIKE '%BRASS%' THEN p_size ELSE 0 END) AS BIGINT) AS gpu_demand
FROM part GROUP BY p_brand""")
def capacity_demand(spark, sf):
    """C15 over parts: cluster = brand, max workers = size, one GPU per worker for BRASS types."""
    p = table(spark, sf, "part").select("p_brand", "p_size", "p_type")
    w = p.select("p_brand", F.col("p_size").alias("max_workers"),
                 F.when(F.col("p_type").contains("BRASS"), 1).otherwise(0).alias("gpus_per_worker"))
    return us.capacity_demand(w, ["p_brand"])


@query("cache_headroom", """
SELECT g.node_group, g.nodes, m.model_mib, g.nodes * 16384 AS limit_mib,
       g.nodes * 16384 > 3 * m.model_mib AS headroom_ok, g.nodes >= 2 AS copies_ok
FROM (SELECT s_nationkey AS node_group, count(*) AS nodes FROM supplier GROUP BY 1) g
JOIN (SELECT node_group, CAST(sum(p_size * 10) AS BIGINT) AS model_mib FROM (
        SELECT DISTINCT s_nationkey AS node_group, l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
      JOIN part ON l_partkey = p_partkey GROUP BY 1) m USING (node_group)""")
def cache_headroom(spark, sf):
    """C16 over suppliers: node group = supplier nation; cached models = distinct parts its
    suppliers ship (10 MiB per size unit), one copy per node, two copies required."""
    s_ = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    nodes = s_.groupBy(F.col("s_nationkey").alias("node_group")).agg(F.count(F.lit(1)).alias("nodes"))
    models = (li.join(s_, li.l_suppkey == s_.s_suppkey).select(F.col("s_nationkey").alias("node_group"), "l_partkey")
                .distinct().join(p, F.col("l_partkey") == p.p_partkey)
                .select("node_group", (F.col("p_size") * 10).alias("model_mib")))
    arts = models.join(nodes, "node_group").select("node_group", "model_mib", F.col("nodes").alias("copies"),
                                                   F.lit(2).alias("min_copies"))
    limits = nodes.select("node_group", "nodes", (F.col("nodes") * 16384).alias("limit_mib"))
    out = us.cache_headroom(arts, limits)
    return out.join(limits.select("node_group", "nodes"), "node_group").select(
        "node_group", "nodes", "model_mib", "limit_mib", "headroom_ok", "copies_ok")


# ---- C17 / C18 --------------------------------------------------------------
@query("device_health", with_views(
    "SELECT count(*) AS devices, count(*) FILTER (WHERE h IN ('Unhealthy', 'Unknown')) AS unhealthy_or_unknown, "
    "count(*) FILTER (WHERE h IN ('Unhealthy', 'Unknown')) > 0 AS release_hold FROM ("
    "SELECT device, arg_max(health, (ts, event_id)) AS h FROM device_events GROUP BY device)", "device_events"))
def device_health(spark, sf):
    return us.device_health(b.device_events(spark, sf))


# Controller freshness budgets (seconds) and the platform-wide limit.
FRESHNESS_BUDGETS = [("view", 45), ("click", 60), ("purchase", 30)]
DEFAULT_FRESHNESS_S, PLATFORM_FRESHNESS_S = 60, 60


@query("freshness_budget", f"""
WITH g AS (
  SELECT event_type AS controller,
         max(s - prev) AS max_lag_s FROM (
    SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s,
           lag(CAST(floor(epoch(ts)) AS BIGINT)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev
    FROM events) GROUP BY event_type),
b AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {v})" for k, v in FRESHNESS_BUDGETS)}) t(controller, budget_s))
SELECT controller, coalesce(max_lag_s, 0) AS max_lag_s, CAST(coalesce(budget_s, {DEFAULT_FRESHNESS_S}) AS BIGINT) AS budget_s,
       coalesce(max_lag_s, 0) <= coalesce(budget_s, {DEFAULT_FRESHNESS_S}) AS within_budget,
       coalesce(max_lag_s, 0) <= {PLATFORM_FRESHNESS_S} AS within_platform_limit
FROM g LEFT JOIN b USING (controller)""")
def freshness_budget(spark, sf):
    """Largest gap between consecutive events per controller vs its freshness budget."""
    e = table(spark, sf, "events").select("event_type", "ts", "event_id")
    gaps = us.max_gap_seconds(e.withColumnRenamed("event_type", "controller"), "controller", "ts", "event_id")
    budgets = spark.createDataFrame(FRESHNESS_BUDGETS, "controller string, budget_s bigint")
    j = gaps.join(bounded_broadcast(budgets, 1_000, "freshness budgets"), "controller", "left")
    bud = F.coalesce(F.col("budget_s"), F.lit(DEFAULT_FRESHNESS_S)).cast("long")
    return j.select("controller", F.col("max_lag_s").cast("long").alias("max_lag_s"), bud.alias("budget_s"),
                    (F.col("max_lag_s") <= bud).alias("within_budget"),
                    (F.col("max_lag_s") <= PLATFORM_FRESHNESS_S).alias("within_platform_limit"))


# ---- C20 / C21 --------------------------------------------------------------
@query("flow_policy", """
SELECT sn.n_nationkey AS src_nation, cn.n_nationkey AS dst_nation, CAST(sum(f.n) AS BIGINT) AS flows,
       sn.n_regionkey = cn.n_regionkey AS allowed
FROM (SELECT l_suppkey, o_custkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) f
JOIN supplier ON f.l_suppkey = s_suppkey JOIN customer ON f.o_custkey = c_custkey
JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN nation cn ON c_nationkey = cn.n_nationkey
GROUP BY ALL""")
def flow_policy(spark, sf):
    """C20: observed (supplier nation -> customer nation) flows, allowed when both are in one region.

    lineitem x orders is the only large join (shuffle on the order key); it is
    pre-aggregated to (supplier, customer) pairs before the dimension joins.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("l_suppkey", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("src_nation"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("dst_nation"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    nb = bounded_broadcast(n, 10_000, "nation")
    j = (pairs.join(s, pairs.l_suppkey == s.s_suppkey).join(c, pairs.o_custkey == c.c_custkey)
              .groupBy("src_nation", "dst_nation").agg(F.sum("n").cast("long").alias("flows")))
    j = (j.join(nb.select(F.col("n_nationkey").alias("src_nation"), F.col("n_regionkey").alias("sr")), "src_nation")
          .join(nb.select(F.col("n_nationkey").alias("dst_nation"), F.col("n_regionkey").alias("dr")), "dst_nation"))
    return j.select("src_nation", "dst_nation", "flows", (F.col("sr") == F.col("dr")).alias("allowed"))


@query("gang_shape", """
SELECT count(*) AS jobs, count(*) FILTER (WHERE parallelism = completions AND gang_min <= parallelism) AS valid_jobs,
       bool_and(parallelism = completions AND gang_min <= parallelism) AS all_valid FROM (
  SELECT l_orderkey, count(*) AS completions, count(DISTINCT l_linenumber) AS parallelism,
         count(DISTINCT l_suppkey) AS gang_min FROM lineitem GROUP BY l_orderkey)""")
def gang_shape(spark, sf):
    """Per job (order) parallelism must equal completions and gang minimum fit in it."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    j = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("completions"),
                                     F.count_distinct("l_linenumber").alias("parallelism"),
                                     F.count_distinct("l_suppkey").alias("gang_min"))
    ok = (F.col("parallelism") == F.col("completions")) & (F.col("gang_min") <= F.col("parallelism"))
    return j.agg(F.count(F.lit(1)).alias("jobs"), F.count_if(ok).alias("valid_jobs"), F.bool_and(ok).alias("all_valid"))
