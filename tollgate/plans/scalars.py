"""Queries of scalar functions (P6-P18), splits (X1-X2), quality roll-ups (Q4-Q7) and set/sort ops."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from tollgate.functions import exprs as X
from tollgate.functions.guards import bounded_broadcast
from tollgate.functions.hashing import sha_prefix, uniform
from tollgate.functions.ranking import prefix_rank
from tollgate.operators import quality as qa
from tollgate.plans.catalog import query
from tollgate.plans.lifecycle import _q2_sql
from tollgate.plans.sqlviews import rnd, u, with_views
from tollgate.sources import bindings as b
from tollgate.sources.tables import table

# Canary stage weights (percent of traffic to the challenger).
CANARY_STAGES = (10, 50, 100)


# ---- P6 .. P12 --------------------------------------------------------------
def _md5u(key: str, salt: str) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 8)) AS BIGINT)"
            f" / CAST(4294967296 AS DOUBLE))")


@query("canary_assign", with_views(
    "SELECT customer_id, " + ", ".join(
        f"CASE WHEN {_md5u('customer_id', 'canary')} < {p / 100.0} THEN 'challenger' ELSE 'champion' END AS arm_{p}"
        for p in CANARY_STAGES) + " FROM churn_base", "churn_base"))
def canary_assign(spark, sf):
    """Sticky md5-bucket assignment per customer for each rollout stage."""
    c = b.churn_base(spark, sf)
    ub = X.md5_bucket("customer_id", "canary")
    return c.select("customer_id", *[F.when(ub < p / 100.0, "challenger").otherwise("champion").alias(f"arm_{p}")
                                     for p in CANARY_STAGES])


@query("clip_round_expr", """
SELECT l_orderkey, l_linenumber, least(greatest(l_discount * 10, 0.2::DOUBLE), 0.6::DOUBLE) AS clipped,
       CAST(ceil(l_quantity * 37 / 25) * 25 AS BIGINT) AS rounded_up FROM lineitem""")
def clip_round_expr(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_quantity")
    return li.select("l_orderkey", "l_linenumber", X.clip(F.col("l_discount") * 10, 0.2, 0.6).alias("clipped"),
                     X.round_up(F.col("l_quantity") * 37, 25).alias("rounded_up"))


@query("span_id_hash", """
SELECT o_orderkey, substr(sha256(substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 32) || ':' || o_orderpriority || ':'
                                 || o_orderstatus), 1, 16) AS span_id FROM orders""")
def span_id_hash(spark, sf):
    """First 16 hex of sha256('trace:name:service')."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    trace = F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 32)
    return o.select("o_orderkey", sha_prefix(16, trace, "o_orderpriority", "o_orderstatus").alias("span_id"))


@query("partition_key_map", with_views(
    "SELECT request_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:00Z') AS partition_key, "
    "model_version || ':' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:00Z') AS composite_key "
    "FROM prediction_log", "prediction_log"))
def partition_key_map(spark, sf):
    p = b.prediction_log(spark, sf)
    return p.select("request_id", X.hour_key("ts").alias("partition_key"),
                    F.concat_ws(":", "model_version", X.hour_key("ts")).alias("composite_key"))


@query("idempotency_key", """
SELECT 'churn-training:' || strftime(o_orderdate, '%Y-%m-%d') AS run_key, min(o_orderkey) AS first_order, count(*) AS attempts
FROM orders GROUP BY 1""")
def idempotency_key(spark, sf):
    """P10: one run per day key; duplicates collapse (dropDuplicates semantics, deterministic keeper)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    k = F.concat(F.lit("churn-training:"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.groupBy(k.alias("run_key")).agg(F.min("o_orderkey").alias("first_order"),
                                             F.count(F.lit(1)).alias("attempts"))


_QTY_TEXT_SQL = ("CASE p_size % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(p_size * 50 AS VARCHAR) || 'm' "
                 "WHEN 2 THEN CAST(p_size AS VARCHAR) || 'Gi' ELSE CAST(p_size AS VARCHAR) || 'Mi' END")


@query("quantity_parse", f"""
SELECT p_partkey, q, v AS value, v / greatest(p_size, 1) BETWEEN 0.25 AND 1.5 AS within_bounds FROM (
  SELECT p_partkey, p_size, q,
         TRY_CAST(regexp_extract(q, '^([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE) *
         CASE regexp_extract(q, '^[0-9]+(\\.[0-9]+)?([A-Za-z]*)$', 2)
              WHEN '' THEN 1.0 WHEN 'm' THEN 0.001 WHEN 'k' THEN 1000.0 WHEN 'M' THEN 1000000.0
              WHEN 'G' THEN 1000000000.0 WHEN 'T' THEN 1000000000000.0 WHEN 'Ki' THEN 1024.0
              WHEN 'Mi' THEN 1048576.0 WHEN 'Gi' THEN 1073741824.0 WHEN 'Ti' THEN 1099511627776.0 END AS v
  FROM (SELECT p_partkey, p_size, {_QTY_TEXT_SQL} AS q FROM part))""")
def quantity_parse(spark, sf):
    """Quantity text -> number and the bounded resize ratio 0.25 <= new/old <= 1.5."""
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    m = F.col("p_size") % 4
    q = (F.when(m == 0, F.col("p_size").cast("string"))
          .when(m == 1, F.concat((F.col("p_size") * 50).cast("string"), F.lit("m")))
          .when(m == 2, F.concat(F.col("p_size").cast("string"), F.lit("Gi")))
          .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("Mi"))))
    d = p.select("p_partkey", "p_size", q.alias("q")).withColumn("value", X.quantity("q"))
    ratio = F.col("value") / F.greatest(F.col("p_size"), F.lit(1))
    return d.select("p_partkey", "q", "value", ratio.between(0.25, 1.5).alias("within_bounds"))


_URI_SQL = ("'oci://registry/' || lower(replace(p_brand, '#', '-')) || CASE WHEN p_size % 5 = 0 THEN ':latest' "
            "WHEN p_size % 7 = 0 THEN ':' WHEN p_size % 11 = 0 THEN '' ELSE ':v' || CAST(p_size AS VARCHAR) END")


@query("pinned_tag_check", f"""
SELECT p_partkey, uri, contains(uri, ':') AND split_part(uri, ':', -1) NOT IN ('', 'latest') AS pinned,
       starts_with(uri, 'oci://') AS oci_scheme FROM (SELECT p_partkey, {_URI_SQL} AS uri FROM part)""")
def pinned_tag_check(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    s = F.col("p_size")
    tag = (F.when(s % 5 == 0, ":latest").when(s % 7 == 0, ":").when(s % 11 == 0, "")
            .otherwise(F.concat(F.lit(":v"), s.cast("string"))))
    uri = F.concat(F.lit("oci://registry/"), F.lower(F.regexp_replace("p_brand", "#", "-")), tag)
    d = p.select("p_partkey", uri.alias("uri"))
    return d.select("p_partkey", "uri", X.pinned_tag("uri").alias("pinned"), F.col("uri").startswith("oci://")
                    .alias("oci_scheme"))


# ---- P13 .. P18 -------------------------------------------------------------
def _attr_pairs_sql() -> str:
    return """[
  {'k': 'service.name', 'v': 'svc' || CAST(user_id % 4 AS VARCHAR)},
  {'k': 'deployment.environment.name', 'v': 'staging'}, {'k': 'k8s.namespace.name', 'v': 'mlops'},
  {'k': 'k8s.pod.name', 'v': CASE WHEN NOT (event_type = 'error' AND value > 150) THEN 'pod-' || CAST(user_id AS VARCHAR) END},
  {'k': 'k8s.container.name', 'v': 'predictor'}, {'k': 'airflow.dag_id', 'v': 'release'},
  {'k': 'airflow.task_id', 'v': event_type}, {'k': 'mlflow.run_id', 'v': 'run-' || CAST(user_id AS VARCHAR)},
  {'k': 'ml.model.name', 'v': 'churn-risk'},
  {'k': 'ml.model.version', 'v': CASE WHEN event_type <> 'signup' THEN '2026.07.0' END},
  {'k': 'ml.model.stage', 'v': 'candidate'}, {'k': 'kserve.inferenceservice.name', 'v': 'churn-risk'},
  {'k': 'inference.gateway.objective', 'v': 'low-latency'}, {'k': 'release.version', 'v': '2026.07.0'},
  {'k': 'slo.name', 'v': CASE WHEN event_type <> 'view' THEN 'latency_p95' END},
  {'k': 'inference.latency_ms', 'v': CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END},
  {'k': 'customer.id', 'v': CAST(user_id AS VARCHAR)}, {'k': 'http.request.body', 'v': props}]"""


_KEYS_SQL = f"list_transform(list_filter({_attr_pairs_sql()}, lambda x: x.v IS NOT NULL), lambda x: x.k)"


@query("attr_redact", f"""
SELECT event_id, array_to_string(list_sort(list_distinct(list_concat(
         list_filter({_KEYS_SQL}, lambda k: k NOT IN ({", ".join(f"'{a}'" for a in b.REDACTED_ATTRIBUTES)}, 'deployment.environment.name')),
         ['deployment.environment.name']))), ',') AS attribute_keys,
       'production' AS environment
FROM events""")
def attr_redact(spark, sf):
    a = b.attrs(spark, sf)
    r = X.redact("attributes", b.REDACTED_ATTRIBUTES, {"deployment.environment.name": "production"})
    d = a.select("event_id", r.alias("m"))
    return d.select("event_id", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("attribute_keys"),
                    F.element_at("m", "deployment.environment.name").alias("environment"))


@query("attr_contract", f"""
SELECT event_id, array_to_string(list_sort(list_filter([{", ".join(f"'{r}'" for r in b.REQUIRED_ATTRIBUTES)}],
                                                       lambda r: NOT list_contains({_KEYS_SQL}, r))), ',') AS missing,
       len(list_filter([{", ".join(f"'{r}'" for r in b.REQUIRED_ATTRIBUTES)}], lambda r: NOT list_contains({_KEYS_SQL}, r))) = 0
         AS complete
FROM events""")
def attr_contract(spark, sf):
    a = b.attrs(spark, sf)
    miss = X.missing_keys("attributes", b.REQUIRED_ATTRIBUTES)
    return a.select("event_id", F.array_join(miss, ",").alias("missing"), (F.size(miss) == 0).alias("complete"))


@query("json_props_extract", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS k FROM events""")
def json_props_extract(spark, sf):
    """Typed read of a nested JSON field with a default."""
    e = table(spark, sf, "events").select("event_id", "props")
    return e.select("event_id", F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1)).alias("k"))


@query("map_value_sum", """
SELECT n_regionkey, CAST(sum(n) AS DOUBLE) AS total, CAST(greatest(count(*) - 1, 0) AS INTEGER) AS fallback_depth
FROM (SELECT n_regionkey, n_nationkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
GROUP BY n_regionkey""")
def map_value_sum(spark, sf):
    """Sum of a map's values and list length - 1, on per-region maps nation -> customers."""
    c = table(spark, sf, "customer").select("c_nationkey")
    n = bounded_broadcast(table(spark, sf, "nation").select("n_nationkey", "n_regionkey"), 10_000, "nation")
    per = c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_regionkey", "n_nationkey") \
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    m = per.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n"))).alias("m"))
    return m.select("n_regionkey", X.col("m").alias("m")).select(
        "n_regionkey", F.aggregate(F.map_values("m"), F.lit(0.0), lambda acc, x: acc + x).alias("total"),
        F.greatest(F.size("m") - 1, F.lit(0)).alias("fallback_depth"))


# Attributes that must stay numeric.
NUMERIC_FIELDS = ["training.duration_ms", "inference.latency_ms", "canary.traffic_percent", "slo.burn_rate"]


@query("numeric_attr_guard", """
WITH f AS (
  SELECT event_type, unnest([
    {'k': 'training.duration_ms', 'v': CASE WHEN event_type <> 'signup' THEN json_extract_string(props, '$.k') END},
    {'k': 'inference.latency_ms', 'v': CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END},
    {'k': 'canary.traffic_percent', 'v': CAST(user_id % 100 AS VARCHAR) || CASE WHEN event_type = 'purchase' THEN '%' ELSE '' END},
    {'k': 'slo.burn_rate', 'v': CASE WHEN event_type <> 'view' THEN CAST(event_id % 40 AS VARCHAR) END}]) AS a FROM events)
SELECT event_type, a.k AS field, count(*) AS rows, count(a.v) AS present, count(TRY_CAST(a.v AS DOUBLE)) AS numeric_rows,
       count(a.v) = count(TRY_CAST(a.v AS DOUBLE)) AS passed
FROM f GROUP BY event_type, a.k""")
def numeric_attr_guard(spark, sf):
    """Every listed attribute that is present must parse as a number, per event type.  By data, latencies of errors
    and the percentages of purchases are texts, and some attributes are absent."""
    e = table(spark, sf, "events").select("event_type", "event_id", "user_id", "value", "props")
    kind = F.col("event_type")
    values = [F.when(kind != "signup", F.get_json_object("props", "$.k")),
              F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string")),
              F.concat((F.col("user_id") % 100).cast("string"), F.when(kind == "purchase", "%").otherwise("")),
              F.when(kind != "view", (F.col("event_id") % 40).cast("string"))]
    fields = e.select("event_type", F.inline(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("v")) for k, v in zip(NUMERIC_FIELDS, values, strict=True)])))
    numeric = F.count_if(X.is_numeric_text(F.col("v")))
    return fields.groupBy("event_type", "field").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("present"), numeric.alias("numeric_rows"),
                                                     (F.count("v") == numeric).alias("passed"))


# Display names of checks and features.
DISPLAY_NAMES = {
    "data_quality_gate": "Data quality", "min_accuracy": "Minimum accuracy", "min_f1": "Minimum F1",
    "max_brier_score": "Max Brier score", "segment_accuracy_gap": "Segment gap",
    "latency_gate_p95_ms": "Latency p95", "row_count_min_500": "Row count",
    "required_columns_present": "Required columns", "no_nulls_in_required_columns": "No nulls",
    "numeric_features_parse": "Numeric features", "binary_target": "Binary target",
    "target_has_signal": "Target signal", "late_payments": "Late payments", "monthly_spend": "Monthly spend",
    "support_tickets": "Support tickets", "tenure_months": "Tenure", "usage_drop_pct": "Usage drop",
}


@query("label_humanize", f"""
SELECT rule, coalesce(CASE rule {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DISPLAY_NAMES.items())} END,
                      replace(rule, '_', ' ')) AS display FROM (SELECT DISTINCT o_orderpriority AS rule FROM orders
UNION SELECT unnest(['min_accuracy', 'binary_target', 'usage_drop_pct']))""")
def label_humanize(spark, sf):
    """Display names for check/feature names found in the data, '_' -> ' ' otherwise."""
    names = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("rule")).unionByName(
        spark.createDataFrame([("min_accuracy",), ("binary_target",), ("usage_drop_pct",)], "rule string")).distinct()
    return names.select("rule", X.humanize("rule", DISPLAY_NAMES).alias("display"))


# ---- X1 / X2 ----------------------------------------------------------------
@query("split_hash", with_views("SELECT customer_id, split FROM churn_split", "churn_split"))
def split_hash(spark, sf):
    """68/16/16 split from a per-key md5 uniform: stable under repartitioning and re-runs."""
    return b.churn_split(spark, sf).select("customer_id", "split")


@query("split_exact", f"""
SELECT customer_id, CASE WHEN r <= floor(n * 0.68) THEN 'train' WHEN r <= floor(n * 0.84) THEN 'validation'
                         ELSE 'test' END AS split FROM (
  SELECT printf('cust_%05d', c_custkey) AS customer_id,
         row_number() OVER (ORDER BY {u('c_custkey', 7)}, c_custkey) AS r, count(*) OVER () AS n FROM customer)""")
def split_exact(spark, sf):
    """Exact sizes floor(.68n), floor(.84n) by global rank of (u(key), key).

    The global rank comes from ``prefix_rank`` (range partitioning + partition
    offsets), not from an un-partitioned window.
    """
    c = table(spark, sf, "customer").select("c_custkey").withColumn("_u", uniform("c_custkey", 7))
    r = prefix_rank(c, [], ["_u", "c_custkey"])
    split = (F.when(F.col("cum") <= F.floor(F.col("n") * 0.68), "train")
              .when(F.col("cum") <= F.floor(F.col("n") * 0.84), "validation").otherwise("test"))
    return r.select(F.format_string("cust_%05d", F.col("c_custkey")).alias("customer_id"), split.alias("split"))


# ---- Q4 .. Q7 ---------------------------------------------------------------
REPORT_TS = _dt.datetime(2024, 2, 1)


@query("quality_suites", with_views(f"""
WITH g AS (SELECT CAST(ts AS DATE) AS day, count(*) AS rows,
                  count(*) FILTER (WHERE latency_ms IS NULL OR status IS NULL) AS null_cells, max(ts) AS max_ts,
                  avg(latency_ms) AS mean_value, avg(CAST(status <> 'success' AS DOUBLE)) AS label_share
           FROM prediction_log GROUP BY 1),
r AS (SELECT avg(latency_ms) AS m, stddev_pop(latency_ms) AS s FROM prediction_log)
SELECT day, rows, null_cells = 0 AS schema_ok,
       {rnd("(epoch(TIMESTAMP '2024-02-01') - floor(epoch(max_ts))) / 86400.0", 4)} AS age_days,
       (epoch(TIMESTAMP '2024-02-01') - floor(epoch(max_ts))) / 86400.0 <= 2.0 AS freshness_ok,
       {rnd('abs(mean_value - r.m) / greatest(r.s, 1e-9)', 4)} AS z_shift,
       abs(mean_value - r.m) / greatest(r.s, 1e-9) <= 3.0 AS distribution_ok,
       {rnd('label_share', 4)} AS label_share, label_share BETWEEN 0.05 AND 0.8 AS label_balance_ok
FROM g, r""", "prediction_log"))
def quality_suites(spark, sf):
    """Q4: schema / freshness / distribution / label-balance per daily partition."""
    p = b.prediction_log(spark, sf).withColumn("day", F.to_date("ts")) \
        .withColumn("err", (F.col("status") != "success").cast("int"))
    ref = bounded_broadcast(p.agg(F.avg("latency_ms").alias("_m"), F.stddev_pop("latency_ms").alias("_s")),
                            1, "reference stats")
    s = qa.quality_suites(p.crossJoin(ref), "day", "ts", "latency_ms", "err", F.lit(REPORT_TS),
                          F.col("_m"), F.col("_s"))
    return s


@query("reconcile_counts", with_views("""
SELECT partition_key, coalesce(s, 0) AS source_rows, coalesce(t, 0) AS target_rows, coalesce(s, 0) - coalesce(t, 0) AS diff,
       coalesce(s, 0) = coalesce(t, 0) AS matched
FROM (SELECT partition_key, count(*) AS s FROM asset_events WHERE asset = 'raw' GROUP BY 1) a
FULL OUTER JOIN (SELECT partition_key, count(*) AS t FROM asset_events WHERE asset = 'canary' GROUP BY 1) b
USING (partition_key)""", "asset_events"))
def reconcile_counts(spark, sf):
    e = b.asset_events(spark, sf)
    return qa.reconcile_counts(e.filter(F.col("asset") == "raw"), e.filter(F.col("asset") == "canary"), "partition_key")


def _gates_sql() -> str:
    from tollgate.plans.lifecycle import _M7_SQL
    return _M7_SQL


@query("check_rollup", with_views(
    "SELECT version, bool_and(passed) AS passed, coalesce(array_to_string(list_sort(list(gate) FILTER (WHERE NOT passed)), ','), '') "
    f"AS failed, count(*) AS checks, {rnd('100.0 * avg(CAST(passed AS DOUBLE))', 2)} AS score_pct FROM ({_gates_sql()}) "
    "GROUP BY version", "scored", "churn_base", "prediction_log"))
def check_rollup(spark, sf):
    """Q6 + Q7: all checks pass -> passed; sorted failed names; score percentage."""
    from tollgate.plans.lifecycle import gate_table
    r = qa.check_rollup(gate_table(spark, sf), ["version"], name="gate")
    return r.withColumn("failed", F.array_join("failed", ","))


@query("score_pct", with_views(
    f"SELECT check_name_group, {rnd('100.0 * count(*) FILTER (WHERE passed) / count(*)', 2)} AS score_pct, "
    "count(*) - count(*) FILTER (WHERE passed) AS gaps FROM (SELECT 'contract' AS check_name_group, passed FROM ("
    + _q2_sql() + ")) GROUP BY 1", "churn_base"))
def score_pct(spark, sf):
    """Q7: round(100 * passed / total, 2) and the number of gaps over the contract checks."""
    c = qa.contract_check(b.churn_base(spark, sf)).withColumn("check_name_group", F.lit("contract"))
    return c.groupBy("check_name_group").agg(
        F.round(100.0 * F.count_if("passed") / F.count(F.lit(1)), 2).alias("score_pct"),
        (F.count(F.lit(1)) - F.count_if("passed")).alias("gaps"))


# ---- O1 .. O6 ---------------------------------------------------------------
@query("multi_key_sort", with_views(
    "SELECT workload, row_number() OVER (ORDER BY priority DESC, submitted, workload) AS position FROM queue_log",
    "queue_log"))
def multi_key_sort(spark, sf):
    """O1: global order (priority desc, submitted asc); positions via the skew-safe global rank."""
    q = b.queue_log(spark, sf).select("workload", (-F.col("priority")).alias("_np"), "submitted")
    return prefix_rank(q, [], ["_np", "submitted", "workload"], totals=False).select("workload", F.col("cum").alias("position"))


@query("set_difference", "SELECT c_custkey FROM customer EXCEPT ALL SELECT DISTINCT o_custkey FROM orders")
def set_difference(spark, sf):
    """O2: customers without any order (required minus observed)."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return c.exceptAll(o)


@query("set_intersect", "SELECT s_nationkey AS nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def set_intersect(spark, sf):
    """O3: nations that have both suppliers and customers."""
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return s.intersect(c)


@query("union_by_name", """
SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nation, s_acctbal AS acctbal, NULL::VARCHAR AS segment,
       'supplier' AS kind FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'customer' FROM customer""")
def union_by_name(spark, sf):
    """Union of tables with differing columns (missing columns become null)."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("acctbal"),
                                            F.lit("supplier").alias("kind"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("acctbal"),
                                            F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    return s.unionByName(c, allowMissingColumns=True)


@query("distinct_sorted", with_views("SELECT DISTINCT cluster_queue, local_queue FROM queue_log WHERE status = 'pending' "
                                     "ORDER BY 1, 2", "queue_log"))
def distinct_sorted(spark, sf):
    """Sorted distinct pending (cluster queue, local queue) pairs."""
    q = b.queue_log(spark, sf).filter(F.col("status") == "pending")
    return q.select("cluster_queue", "local_queue").distinct().orderBy("cluster_queue", "local_queue")


@query("gap_max_min", f"""
SELECT r_regionkey, coalesce({rnd('max(c_acctbal) - min(c_acctbal)', 2)}, 0.0) AS acctbal_gap
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
GROUP BY r_regionkey""")
def gap_max_min(spark, sf):
    """Max - min per group with default 0 when the group is empty."""
    r = table(spark, sf, "region").select("r_regionkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    c = table(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    cn = c.join(bounded_broadcast(n, 10_000, "nation"), c.c_nationkey == n.n_nationkey) \
        .groupBy("n_regionkey").agg(F.round(F.max("c_acctbal") - F.min("c_acctbal"), 2).alias("g"))
    j = r.join(cn, r.r_regionkey == cn.n_regionkey, "left")
    return j.select("r_regionkey", F.coalesce(F.col("g"), F.lit(0.0)).alias("acctbal_gap"))
