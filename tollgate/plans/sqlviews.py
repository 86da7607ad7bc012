"""DuckDB SQL twins of ``tollgate.sources.bindings`` for the oracle check.

``with_views(sql, *names)`` prefixes the CTEs a query needs (dependencies
first).  Rounding uses ``rnd`` (HALF_UP on the shortest decimal text), which is
what Spark's ``round`` does on doubles; DuckDB's plain ``round`` differs on ties.
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def u(key: str, seed) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"
            f" / CAST(4294967296 AS DOUBLE))")


def sig(x: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({x}))))"


_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: tuple[str, ...], body: str) -> None:
    _VIEWS[name] = (deps, body)


def with_views(sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{_VIEWS[n][1]}\n)" for n in order)
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"


_usage = ("CASE WHEN coalesce(pc.n_before, 0) = 0 THEN 0.0::DOUBLE ELSE "
          + rnd("least(greatest(1 - coalesce(pc.n_after, 0) / pc.n_before, 0.0::DOUBLE), 0.9::DOUBLE)", 4)
          + " END")

view("churn_rows", (), f"""
SELECT c.c_custkey,
       printf('cust_%05d', c.c_custkey) AS customer_id,
       CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'enterprise' ELSE 'self_serve' END AS segment,
       CAST(greatest(coalesce(pc.n_months, 0), 1) AS INTEGER) AS tenure_months,
       {rnd("coalesce(pc.total_price, 0.0::DOUBLE) / greatest(coalesce(pc.n_months, 0), 1) / 1000", 2)} AS monthly_spend,
       CAST(coalesce(pc.n_urgent, 0) AS INTEGER) AS support_tickets,
       CAST(coalesce(pc.n_high_open, 0) AS INTEGER) AS late_payments,
       {_usage} AS usage_drop_pct
FROM customer c
LEFT JOIN (
  SELECT o_custkey,
         count(DISTINCT year(o_orderdate) * 100 + month(o_orderdate)) AS n_months,
         sum(o_totalprice) AS total_price,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
         count(*) FILTER (WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'O') AS n_high_open,
         count(*) FILTER (WHERE CAST(o_orderdate AS DATE) >= DATE '1998-04-01') AS n_after,
         count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1998-04-01') AS n_before
  FROM orders GROUP BY o_custkey) pc ON c.c_custkey = pc.o_custkey""")

_logit = ("(-1.8 - 0.025 * tenure_months + 0.24 * support_tickets + 0.70 * late_payments"
          " + 4.8 * usage_drop_pct + CASE WHEN segment = 'enterprise' THEN -0.35 ELSE 0.0 END)::DOUBLE")

view("churn_base", ("churn_rows",), f"""
SELECT *, CAST({u('c_custkey', 42)} < {sig(_logit)} AS INTEGER) AS churned FROM churn_rows""")

view("churn_split", ("churn_base",), f"""
SELECT *, CASE WHEN {u('c_custkey', 7)} < 0.68 THEN 'train'
               WHEN {u('c_custkey', 7)} < 0.84 THEN 'validation' ELSE 'test' END AS split
FROM churn_base""")

view("churn_current", ("churn_base",), f"""
SELECT * REPLACE ({rnd('monthly_spend * 1.12', 2)} AS monthly_spend)
FROM churn_base""")

view("prediction_log", (), f"""
SELECT event_id AS request_id, ts,
       'svc' || CAST(user_id % 4 AS VARCHAR) AS service,
       '2026.07.' || CAST(user_id % 3 AS VARCHAR) AS model_version,
       user_id,
       value AS latency_ms,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
       {rnd(sig('(value - 35) / 20'), 6)} AS churn_score
FROM events""")

view("request_counters", ("prediction_log",), """
SELECT service, ts, request_id,
       CAST(count(*) OVER w AS DOUBLE) AS requests_total,
       CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) OVER w AS DOUBLE) AS errors_total
FROM prediction_log
WINDOW w AS (PARTITION BY service, CAST(ts AS DATE) ORDER BY ts, request_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

view("latency_buckets", ("prediction_log",), """
SELECT service, CAST(ts AS DATE) AS day, b.le,
       count(*) FILTER (WHERE latency_ms <= b.le) AS bucket_count
FROM prediction_log,
     (VALUES (5.0::DOUBLE), (10.0::DOUBLE), (25.0::DOUBLE), (50.0::DOUBLE), (100.0::DOUBLE),
             (250.0::DOUBLE), ('inf'::DOUBLE)) b(le)
GROUP BY ALL""")

view("asset_events", (), """
SELECT * FROM (
  SELECT event_id, ts,
         CASE WHEN event_type = 'view' THEN 'raw'
              WHEN event_type = 'click' THEN 'candidate'
              WHEN event_type = 'purchase' THEN 'canary'
              WHEN event_type = 'error' AND value > 150 THEN 'rollback_request' END AS asset,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:00Z') AS partition_key
  FROM events) WHERE asset IS NOT NULL""")

view("device_events", (), """
SELECT user_id AS device, ts, event_id,
       CASE WHEN event_type = 'error' THEN 'Unhealthy'
            WHEN event_type = 'signup' THEN 'Unknown' ELSE 'Healthy' END AS health
FROM events""")

# ---- model chain (train stats -> registered models -> scored rows) ----------
from tollgate.operators.model import FEATURES as _FEATS, REGISTERED_MODELS as _MODELS  # noqa: E402


def _std(x: str) -> str:
    return f"CASE WHEN stddev_pop({x}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({x}) END"


view("train_stats", ("churn_split",), "SELECT " + ", ".join(
    f"{rnd(f'avg({f})', 6)} AS mean_{f}, {rnd(_std(f), 6)} AS std_{f}" for f in _FEATS)
    + " FROM churn_split WHERE split = 'train'")


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"


_model_cols = ["model", "version", "role", "bias", *[f"w_{f}" for f in _FEATS], "enterprise_adj", "threshold"]
view("models", ("train_stats",),
     "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(_lit(v) for v in row) + ")" for row in _MODELS)
     + f") m({', '.join(_model_cols)}) CROSS JOIN train_stats")

_z = " + ".join(f"m.w_{f} * (s.{f} - m.mean_{f}) / greatest(m.std_{f}, 1e-9::DOUBLE)" for f in _FEATS)
_logit_m = (f"(m.bias + {_z} + CASE WHEN s.segment = 'enterprise' THEN coalesce(m.enterprise_adj, -0.25::DOUBLE)"
            " ELSE 0.0::DOUBLE END)")
view("scored", ("churn_split", "models"), f"""
SELECT q.*, CAST(q.churn_score >= q.threshold AS INTEGER) AS prediction FROM (
  SELECT s.*, m.model, m.version, m.threshold,
         {rnd(sig(f'greatest(least({_logit_m}, 35.0::DOUBLE), -35.0::DOUBLE)'), 6)} AS churn_score
  FROM churn_split s CROSS JOIN models m) q""")

view("hourly", ("prediction_log",), """
SELECT service, date_trunc('hour', ts) AS hour, count(*) AS requests,
       count(*) FILTER (WHERE status <> 'success') AS errors,
       count(*) FILTER (WHERE status <> 'success') / count(*) AS error_share,
       max(latency_ms) AS max_latency
FROM prediction_log GROUP BY ALL""")

view("alloc_samples", (), """
SELECT 'ns' || CAST(l_partkey % 10 AS VARCHAR) AS namespace,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS pod,
       l_suppkey AS node, l_quantity / 50 AS cpu, l_extendedprice * 1048576 AS mem_bytes,
       l_returnflag AS team, CASE WHEN l_partkey % 7 = 0 THEN '' ELSE l_linestatus END AS cost_center,
       l_shipdate AS ts
FROM lineitem""")

view("allocations", (), """
SELECT 'ns' || CAST(l_partkey % 10 AS VARCHAR) AS namespace, 'deploy' || CAST(l_partkey % 4 AS VARCHAR) AS deployment,
       'svc' || CAST(l_orderkey % 4 AS VARCHAR) AS service, l_returnflag AS label_team,
       CASE WHEN l_partkey % 7 = 0 THEN '' ELSE l_linestatus END AS label_cost_center,
       '2026.07.' || CAST(l_orderkey % 3 AS VARCHAR) AS label_model,
       CASE WHEN l_linenumber = 1 THEN 'training' ELSE 'serving' END AS label_workload_type, l_suppkey AS node, l_quantity / 50 AS cpu
FROM lineitem""")

view("node_prices", (), """
SELECT s_suppkey AS node, 0.02::DOUBLE + (s_suppkey % 10) * 0.005::DOUBLE AS cpu_h,
       0.003::DOUBLE + (s_suppkey % 7) * 0.0005::DOUBLE AS ram_h,
       CASE WHEN s_suppkey % 5 = 0 THEN 1.2::DOUBLE ELSE 0.0::DOUBLE END AS gpu_h
FROM supplier""")

view("workload_samples", (), """
SELECT l_partkey AS workload, l_quantity * 20 AS cpu_m, l_extendedprice / 50 AS mem_mib, p_size
FROM lineitem JOIN part ON l_partkey = p_partkey""")

view("tenant_usage", (), """
SELECT n_name AS tenant, n_nationkey AS tenant_key, n_regionkey AS cohort,
       coalesce(n_cust, 0) / 10.0::DOUBLE AS cpu_quota, coalesce(n_pos, 0) / 10.0::DOUBLE * 0.8::DOUBLE AS cpu_used,
       coalesce(bal, 0) / 1000.0::DOUBLE AS memory_quota_gib, coalesce(sbal, 0) / 1000.0::DOUBLE AS memory_used_gib,
       CAST(coalesce(n_sup, 0) AS DOUBLE) AS pool_slots, CAST(coalesce(n_rich, 0) AS DOUBLE) AS pool_used,
       CASE WHEN n_nationkey % 3 = 2 THEN 'mlops-low-priority' ELSE 'mlops-batch-normal' END AS priority_class
FROM nation
LEFT JOIN (SELECT c_nationkey, count(*) AS n_cust, count(*) FILTER (WHERE c_acctbal > 0) AS n_pos,
                  sum(greatest(c_acctbal, 0.0)) AS bal FROM customer GROUP BY 1) c ON n_nationkey = c.c_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS n_sup, count(*) FILTER (WHERE s_acctbal > 5000) AS n_rich,
                  sum(greatest(s_acctbal, 0.0)) AS sbal FROM supplier GROUP BY 1) s ON n_nationkey = s.s_nationkey""")

view("registry_events", (), """
SELECT o_custkey AS model, o_orderkey AS version, o_orderdate AS ts,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'rollback'
            WHEN o_orderstatus IN ('F', 'P') THEN 'promote' ELSE 'register' END AS event,
       o_orderpriority <> '1-URGENT' AND o_orderstatus = 'F' AS gates_passed
FROM orders""")

view("spans", (), """
SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS trace_id,
       substr(sha256(sha256(CAST(o_orderkey AS VARCHAR)) || ':orders:0'), 1, 16) AS span_id,
       NULL::VARCHAR AS parent_span_id, 'orders' AS service, 0 AS seq,
       CAST(round(CAST(CAST(o_totalprice / 10000 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS duration_ms
FROM orders
UNION ALL
SELECT t, substr(sha256(t || ':line:' || CAST(seq AS VARCHAR)), 1, 16),
       CASE WHEN seq = 1 THEN substr(sha256(t || ':orders:0'), 1, 16)
            ELSE substr(sha256(t || ':line:' || CAST(seq - 1 AS VARCHAR)), 1, 16) END,
       l_returnflag, seq, l_quantity
FROM (SELECT sha256(CAST(l_orderkey AS VARCHAR)) AS t, l_returnflag, l_quantity,
             CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                     l_extendedprice) AS INTEGER) AS seq
      FROM lineitem)""")

view("queue_log", (), """
SELECT o_orderkey AS workload, o_orderpriority AS cluster_queue, 'lq' || CAST(o_custkey % 5 AS VARCHAR) AS local_queue,
       CASE WHEN o_orderstatus = 'F' THEN 'admitted' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'preempted' END
         AS status,
       o_custkey % 1001 AS priority, o_orderdate AS submitted,
       CAST(round(CAST(CAST(o_totalprice / 100000 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS requested_cpu
FROM orders""")

view("shard_results", (), """
SELECT l_orderkey AS job, l_linenumber AS idx,
       CASE WHEN l_returnflag = 'A' THEN '0' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '42'
            WHEN l_returnflag = 'N' THEN 'DisruptionTarget' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '78'
            ELSE '0' END AS exit_code,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice)
         AS attempt
FROM lineitem""")
