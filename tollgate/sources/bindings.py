"""Views of the lifecycle data model built from the input tables.

Each function derives one logical table of the data model (churn rows,
prediction log, cost samples, ...) from the driver's tables with plain
DataFrame operations, so its size grows with theirs.  The DuckDB twins used
by the oracle live in ``tollgate.plans.sqlviews``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.hashing import uniform
from tollgate.sources.tables import table

# Fixed values of the churn generator's logit (label model), without its noise term.
CHURN_LOGIT = {
    "intercept": -1.8,
    "tenure_months": -0.025,
    "support_tickets": 0.24,
    "late_payments": 0.70,
    "usage_drop_pct": 4.8,
    "enterprise": -0.35,
}
USAGE_CUTOFF = _dt.date(1998, 4, 1)
ENTERPRISE_SEGMENTS = ("BUILDING", "MACHINERY")
FEATURES = ("tenure_months", "monthly_spend", "support_tickets", "late_payments", "usage_drop_pct")


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def churn_base(spark: SparkSession, sf: str) -> DataFrame:
    """One churn row per customer; features aggregated from the customer's orders.

    The order aggregate is keyed by o_custkey, so the left join from customer
    reuses its hash partitioning (only the customer side is exchanged).
    """
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    day = F.to_date("o_orderdate")
    per_cust = orders.groupBy("o_custkey").agg(
        F.count_distinct(F.year(day) * 100 + F.month(day)).alias("n_months"),
        F.sum("o_totalprice").alias("total_price"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_if((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "O")).alias("n_high_open"),
        F.count_if(day >= F.lit(USAGE_CUTOFF)).alias("n_after"),
        F.count_if(day < F.lit(USAGE_CUTOFF)).alias("n_before"),
    )
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
    tenure = F.greatest(F.coalesce(F.col("n_months"), F.lit(0)), F.lit(1)).cast("int")
    n_before = F.coalesce(F.col("n_before"), F.lit(0))
    usage = F.when(n_before == 0, F.lit(0.0)).otherwise(
        F.round(F.least(F.greatest(1 - F.coalesce(F.col("n_after"), F.lit(0)) / n_before, F.lit(0.0)),
                        F.lit(0.9)), 4))
    base = j.select(
        F.col("c_custkey"),
        F.format_string("cust_%05d", F.col("c_custkey")).alias("customer_id"),
        F.when(F.col("c_mktsegment").isin(*ENTERPRISE_SEGMENTS), "enterprise")
         .otherwise("self_serve").alias("segment"),
        tenure.alias("tenure_months"),
        F.round(F.coalesce(F.col("total_price"), F.lit(0.0)) / tenure / 1000, 2).alias("monthly_spend"),
        F.coalesce(F.col("n_urgent"), F.lit(0)).cast("int").alias("support_tickets"),
        F.coalesce(F.col("n_high_open"), F.lit(0)).cast("int").alias("late_payments"),
        usage.cast("double").alias("usage_drop_pct"),
    )
    lg = CHURN_LOGIT
    logit = (F.lit(lg["intercept"]) + lg["tenure_months"] * F.col("tenure_months")
             + lg["support_tickets"] * F.col("support_tickets")
             + lg["late_payments"] * F.col("late_payments")
             + lg["usage_drop_pct"] * F.col("usage_drop_pct")
             + F.when(F.col("segment") == "enterprise", F.lit(lg["enterprise"])).otherwise(F.lit(0.0)))
    return base.withColumn("churned", (uniform("c_custkey", 42) < _sigmoid(logit)).cast("int"))


def with_split(df: DataFrame, key: str = "c_custkey", seed: int = 7,
               train: float = 0.68, validation: float = 0.84) -> DataFrame:
    """Hash split column (train/validation/test); stable under repartitioning."""
    u = uniform(key, seed)
    return df.withColumn("split", F.when(u < train, "train").when(u < validation, "validation")
                         .otherwise("test"))


def churn_split(spark: SparkSession, sf: str) -> DataFrame:
    return with_split(churn_base(spark, sf))


def churn_current(spark: SparkSession, sf: str, drift: float = 1.12) -> DataFrame:
    """Current scoring population: all customers, with spend drifted."""
    return churn_base(spark, sf).withColumn("monthly_spend", F.round(F.col("monthly_spend") * drift, 2))


def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction log derived from ``events`` (one request per event)."""
    return to_prediction_log(table(spark, sf, "events"))


def to_prediction_log(e: DataFrame) -> DataFrame:
    """Events (batch or stream) -> prediction log rows."""
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("ts"),
        F.concat(F.lit("svc"), (F.col("user_id") % 4).cast("string")).alias("service"),
        F.concat(F.lit("2026.07."), (F.col("user_id") % 3).cast("string")).alias("model_version"),
        F.col("user_id"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.round(_sigmoid((F.col("value") - 35) / 20), 6).alias("churn_score"),
    )


def request_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Cumulative counters requests_total / errors_total per (service, day).

    Counters restart every midnight (a reset).  Running counts come from the
    skew-safe ``prefix_rank`` (range partitioning + offsets), so even a
    (service, day) holding a third of all requests is split over many tasks.
    """
    from tollgate.functions.ranking import prefix_rank
    p = (prediction_log(spark, sf).withColumn("day", F.to_date("ts"))
         .withColumn("one", F.lit(1)).withColumn("err", (F.col("status") == "error").cast("int"))
         .select("service", "day", "ts", "request_id", "one", "err"))
    r = prefix_rank(p, ["service", "day"], ["ts", "request_id"], weight=["one", "err"], totals=False)
    return r.select("service", "ts", "request_id", F.col("cum_one").cast("double").alias("requests_total"),
                    F.col("cum_err").cast("double").alias("errors_total"))


LATENCY_BOUNDS = (5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def latency_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Cumulative latency histogram per (service, day, le) incl. le=+Inf.

    One partial aggregate of per-bound indicator sums; the 7 bucket rows are
    produced after the aggregate (stack), so no row is duplicated before the
    shuffle.
    """
    p = prediction_log(spark, sf).withColumn("day", F.to_date("ts"))
    aggs = [F.count_if(F.col("latency_ms") <= b).alias(f"c{i}") for i, b in enumerate(LATENCY_BOUNDS)]
    g = p.groupBy("service", "day").agg(*aggs, F.count(F.lit(1)).alias("cinf"))
    pairs = ", ".join([f"{b}D, c{i}" for i, b in enumerate(LATENCY_BOUNDS)] + ["double('inf'), cinf"])
    return g.selectExpr("service", "day",
                        f"stack({len(LATENCY_BOUNDS) + 1}, {pairs}) as (le, bucket_count)")


def asset_events(spark: SparkSession, sf: str) -> DataFrame:
    """Asset materialisation events: view→raw, click→candidate, purchase→canary,
    error with value > 150 → rollback_request; partition key = hour of ts."""
    return to_asset_events(table(spark, sf, "events"))


def to_asset_events(e: DataFrame) -> DataFrame:
    """Events (batch or stream) -> asset materialisation events."""
    asset = (F.when(F.col("event_type") == "view", "raw")
              .when(F.col("event_type") == "click", "candidate")
              .when(F.col("event_type") == "purchase", "canary")
              .when((F.col("event_type") == "error") & (F.col("value") > 150), "rollback_request"))
    return (e.select("event_id", "ts", asset.alias("asset"),
                     F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:00'Z'").alias("partition_key"))
             .filter(F.col("asset").isNotNull()))


def device_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    health = (F.when(F.col("event_type") == "error", "Unhealthy")
               .when(F.col("event_type") == "signup", "Unknown").otherwise("Healthy"))
    return e.select(F.col("user_id").alias("device"), "ts", "event_id", health.alias("health"))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Per (service, hour) request/error counts: the evaluation-step table of alerts."""
    p = prediction_log(spark, sf)
    return p.groupBy("service", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") != "success").alias("errors"),
        (F.count_if(F.col("status") != "success") / F.count(F.lit(1))).alias("error_share"),
        F.max("latency_ms").alias("max_latency"))


def alloc_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Container allocation samples (one per lineitem): namespace, pod, node, cpu, memory, labels."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                             "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
                                             "l_shipdate")
    return li.select(
        F.concat(F.lit("ns"), (F.col("l_partkey") % 10).cast("string")).alias("namespace"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("pod"),
        F.col("l_suppkey").alias("node"),
        (F.col("l_quantity") / 50).alias("cpu"),
        (F.col("l_extendedprice") * 1048576).alias("mem_bytes"),
        F.col("l_returnflag").alias("team"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit("")).otherwise(F.col("l_linestatus")).alias("cost_center"),
        F.col("l_shipdate").alias("ts"),
    )


def allocations(spark: SparkSession, sf: str) -> DataFrame:
    """Allocation samples under the seven cost dimensions (one per lineitem)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    numbered = lambda name, key, n: F.concat(F.lit(name), (F.col(key) % n).cast("string"))
    return li.select(
        numbered("ns", "l_partkey", 10).alias("namespace"), numbered("deploy", "l_partkey", 4).alias("deployment"),
        numbered("svc", "l_orderkey", 4).alias("service"), F.col("l_returnflag").alias("label_team"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit("")).otherwise(F.col("l_linestatus")).alias("label_cost_center"),
        numbered("2026.07.", "l_orderkey", 3).alias("label_model"),
        F.when(F.col("l_linenumber") == 1, "training").otherwise("serving").alias("label_workload_type"),
        F.col("l_suppkey").alias("node"), (F.col("l_quantity") / 50).alias("cpu"))


def node_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly node prices (one row per supplier = node)."""
    s = table(spark, sf, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    return s.select(k.alias("node"), (0.02 + (k % 10) * 0.005).alias("cpu_h"),
                    (0.003 + (k % 7) * 0.0005).alias("ram_h"),
                    F.when(k % 5 == 0, F.lit(1.2)).otherwise(F.lit(0.0)).alias("gpu_h"))


def workload_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Usage samples per workload (= part) with the workload's current sizing from ``part``."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    s = li.select(F.col("l_partkey").alias("workload"), (F.col("l_quantity") * 20).alias("cpu_m"),
                  (F.col("l_extendedprice") / 50).alias("mem_mib"))
    return s.join(p, s.workload == p.p_partkey, "inner").drop("p_partkey")


def tenant_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Tenants = nations, cohorts = regions; quotas/usage from customer and supplier aggregates."""
    n = table(spark, sf, "nation")
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_cust"), F.count_if(F.col("c_acctbal") > 0).alias("n_pos"),
        F.sum(F.greatest(F.col("c_acctbal"), F.lit(0.0))).alias("bal"))
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n_sup"), F.count_if(F.col("s_acctbal") > 5000).alias("n_rich"),
        F.sum(F.greatest(F.col("s_acctbal"), F.lit(0.0))).alias("sbal"))
    j = n.join(c, n.n_nationkey == c.c_nationkey, "left").join(s, n.n_nationkey == s.s_nationkey, "left")
    z = lambda x: F.coalesce(F.col(x), F.lit(0))
    return j.select(
        F.col("n_name").alias("tenant"), F.col("n_nationkey").alias("tenant_key"),
        F.col("n_regionkey").alias("cohort"),
        (z("n_cust") / 10.0).alias("cpu_quota"), (z("n_pos") / 10.0 * 0.8).alias("cpu_used"),
        (z("bal") / 1000.0).alias("memory_quota_gib"), (z("sbal") / 1000.0).alias("memory_used_gib"),
        z("n_sup").cast("double").alias("pool_slots"), z("n_rich").cast("double").alias("pool_used"),
        F.when(F.col("n_nationkey") % 3 == 2, "mlops-low-priority").otherwise("mlops-batch-normal")
         .alias("priority_class"),
    )


def registry_events(spark: SparkSession, sf: str) -> DataFrame:
    """Model registry event log: model = customer, version = order, one event per order.

    1-URGENT -> rollback; otherwise status F -> promote (gates passed),
    P -> promote (gates failed), O -> register.
    """
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                          "o_orderpriority")
    ev = (F.when(F.col("o_orderpriority") == "1-URGENT", "rollback")
           .when(F.col("o_orderstatus").isin("F", "P"), "promote").otherwise("register"))
    return o.select(F.col("o_custkey").alias("model"), F.col("o_orderkey").alias("version"),
                    F.col("o_orderdate").alias("ts"), ev.alias("event"),
                    ((F.col("o_orderpriority") != "1-URGENT") & (F.col("o_orderstatus") == "F")).alias("gates_passed"))


def spans(spark: SparkSession, sf: str) -> DataFrame:
    """Trace spans: one trace per order (root span 'orders'), its lineitems chained as children.

    Child order is (l_linenumber, l_partkey, l_suppkey, l_extendedprice); the
    position in the chain comes from the skew-safe ``prefix_rank`` (an order
    with a huge number of lines is still split over tasks).
    """
    from tollgate.functions.hashing import sha_prefix
    from tollgate.functions.ranking import prefix_rank
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             "l_extendedprice", "l_quantity", "l_returnflag")
    tid = F.sha2(F.col("o_orderkey").cast("string"), 256)
    root = o.select(tid.alias("trace_id"), sha_prefix(16, tid, F.lit("orders"), F.lit("0")).alias("span_id"),
                    F.lit(None).cast("string").alias("parent_span_id"), F.lit("orders").alias("service"),
                    F.lit(0).alias("seq"), F.round(F.col("o_totalprice") / 10000, 2).alias("duration_ms"))
    ch = (prefix_rank(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], totals=False)
          .withColumn("seq", F.col("cum").cast("int"))
          .withColumn("trace_id", F.sha2(F.col("l_orderkey").cast("string"), 256)))
    span_id = sha_prefix(16, F.col("trace_id"), F.lit("line"), F.col("seq").cast("string"))
    parent = F.when(F.col("seq") == 1, sha_prefix(16, F.col("trace_id"), F.lit("orders"), F.lit("0"))) \
              .otherwise(sha_prefix(16, F.col("trace_id"), F.lit("line"), (F.col("seq") - 1).cast("string")))
    child = ch.select("trace_id", span_id.alias("span_id"), parent.alias("parent_span_id"),
                      F.col("l_returnflag").alias("service"), "seq", F.col("l_quantity").alias("duration_ms"))
    return root.unionByName(child)


def queue_log(spark: SparkSession, sf: str) -> DataFrame:
    """Workload decision log: queue = order priority; F admitted, O pending, P preempted."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                          "o_orderdate", "o_totalprice")
    status = (F.when(F.col("o_orderstatus") == "F", "admitted").when(F.col("o_orderstatus") == "O", "pending")
               .otherwise("preempted"))
    return o.select(F.col("o_orderkey").alias("workload"), F.col("o_orderpriority").alias("cluster_queue"),
                    F.concat(F.lit("lq"), (F.col("o_custkey") % 5).cast("string")).alias("local_queue"),
                    status.alias("status"), (F.col("o_custkey") % 1001).alias("priority"),
                    F.col("o_orderdate").alias("submitted"),
                    F.round(F.col("o_totalprice") / 100000, 2).alias("requested_cpu"))


def shard_results(spark: SparkSession, sf: str) -> DataFrame:
    """Indexed-job attempts: job = order, index = line number, exit code from return flag/status."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             "l_extendedprice", "l_returnflag", "l_linestatus")
    from tollgate.functions.ranking import prefix_rank
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    code = (F.when(rf == "A", "0").when((rf == "N") & (ls == "F"), "42").when(rf == "N", "DisruptionTarget")
             .when((rf == "R") & (ls == "F"), "78").otherwise("0"))
    ranked = prefix_rank(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"], totals=False)
    return ranked.select(F.col("l_orderkey").alias("job"), F.col("l_linenumber").alias("idx"),
                         code.alias("exit_code"), F.col("cum").cast("int").alias("attempt"))


# Telemetry attribute contract (required, redacted, numeric).
REQUIRED_ATTRIBUTES = [
    "service.name", "deployment.environment.name", "k8s.namespace.name", "k8s.pod.name", "k8s.container.name",
    "airflow.dag_id", "airflow.task_id", "mlflow.run_id", "ml.model.name", "ml.model.version", "ml.model.stage",
    "kserve.inferenceservice.name", "inference.gateway.objective", "release.version", "slo.name",
]
REDACTED_ATTRIBUTES = ["prediction.request.features", "prediction.response.score", "http.request.body", "customer.id"]


def attrs(spark: SparkSession, sf: str) -> DataFrame:
    """Span attributes per event: a MAP of event columns under the contract's attribute names.

    Some attributes are absent by data: no model version on signups, no pod on
    errors above 150 ms, no SLO name on views.
    """
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    s = F.col("user_id").cast("string")
    pairs = [
        ("service.name", F.concat(F.lit("svc"), (F.col("user_id") % 4).cast("string"))),
        ("deployment.environment.name", F.lit("staging")),
        ("k8s.namespace.name", F.lit("mlops")),
        ("k8s.pod.name", F.when(~((F.col("event_type") == "error") & (F.col("value") > 150)), F.concat(F.lit("pod-"), s))),
        ("k8s.container.name", F.lit("predictor")),
        ("airflow.dag_id", F.lit("release")), ("airflow.task_id", F.col("event_type")),
        ("mlflow.run_id", F.concat(F.lit("run-"), s)), ("ml.model.name", F.lit("churn-risk")),
        ("ml.model.version", F.when(F.col("event_type") != "signup", F.lit("2026.07.0"))),
        ("ml.model.stage", F.lit("candidate")), ("kserve.inferenceservice.name", F.lit("churn-risk")),
        ("inference.gateway.objective", F.lit("low-latency")), ("release.version", F.lit("2026.07.0")),
        ("slo.name", F.when(F.col("event_type") != "view", F.lit("latency_p95"))),
        ("inference.latency_ms", F.when(F.col("event_type") == "error", F.lit("n/a"))
                                  .otherwise(F.col("value").cast("string"))),
        ("customer.id", s), ("http.request.body", F.col("props")),
    ]
    m = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs]),
                                    lambda x: x["value"].isNotNull()))
    return e.select("event_id", "event_type", m.alias("attributes"))
