"""Queries of the time-series algebra (T) and SLO burn (R1-R4) families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollgate.functions.ranking import nearest_rank_percentiles
from tollgate.operators import monitoring as mon
from tollgate.operators import slo
from tollgate.operators import timeseries as ts
from tollgate.plans.catalog import query
from tollgate.plans.sqlviews import rnd, with_views
from tollgate.sources import bindings as b
from tollgate.sources.tables import table


# ---- T1 ---------------------------------------------------------------------
@query("label_match", with_views(
    "SELECT request_id, service, status FROM prediction_log "
    "WHERE regexp_full_match(service, 'svc[01]') AND status <> 'error' AND model_version <> '2026.07.2'",
    "prediction_log"))
def label_match(spark, sf):
    p = b.prediction_log(spark, sf)
    m = ts.label_match(p, [("service", "=~", "svc[01]"), ("status", "!=", "error"),
                           ("model_version", "!=", "2026.07.2")])
    return m.select("request_id", "service", "status")


# ---- T2 / T3 / T4 -----------------------------------------------------------
def _inc_sql(value: str, seconds: int, alias: str = "increase") -> str:
    return f"""
SELECT service, window_start, sum(d) AS {alias}, count(*) AS samples FROM (
  SELECT service, window_start,
         CASE WHEN prev IS NULL THEN 0.0 WHEN v >= prev THEN v - prev ELSE v END AS d FROM (
    SELECT service, time_bucket(INTERVAL {seconds} SECONDS, ts) AS window_start, {value} AS v,
           lag({value}) OVER (PARTITION BY service, time_bucket(INTERVAL {seconds} SECONDS, ts)
                              ORDER BY ts, request_id) AS prev
    FROM request_counters))
GROUP BY ALL"""


@query("counter_increase", with_views(_inc_sql("requests_total", 3600), "request_counters"))
def counter_increase(spark, sf):
    c = b.request_counters(spark, sf)
    return ts.counter_increase(c, ["service"], "ts", "requests_total", 3600, tiebreak=["request_id"])


@query("counter_rate", with_views(
    f"SELECT service, window_start, {rnd('increase / 300.0', 6)} AS rate FROM ({_inc_sql('requests_total', 300)})",
    "request_counters"))
def counter_rate(spark, sf):
    c = b.request_counters(spark, sf)
    r = ts.counter_rate(c, ["service"], "ts", "requests_total", 300, tiebreak=["request_id"])
    return r.select("service", "window_start", F.round("rate", 6).alias("rate"))


@query("counter_rate_sliding", with_views(f"""
SELECT service, window_start, {rnd('sum(CASE WHEN prev IS NULL THEN 0.0 WHEN v >= prev THEN v - prev ELSE v END) / 3600.0', 6)} AS rate, count(*) AS samples FROM (
  SELECT *, lag(v) OVER (PARTITION BY service, window_start ORDER BY ts, request_id) AS prev FROM (
    SELECT service, ts, request_id, requests_total AS v, time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL (k * 5) MINUTES AS window_start
    FROM request_counters, range(0, 12) r(k)))
GROUP BY service, window_start""", "request_counters"))
def counter_rate_sliding(spark, sf):
    """Request rate over the last hour, every five minutes."""
    r = ts.sliding_rate(b.request_counters(spark, sf), ["service"], "ts", "requests_total", 3600, 300, tiebreak=["request_id"])
    return r.select("service", "window_start", F.round("rate", 6).alias("rate"), "samples")


@query("rate_ratio", with_views(
    f"SELECT e.service, e.window_start, {rnd('e.inc / nullif(r.inc, 0)', 6)} AS ratio "
    f"FROM ({_inc_sql('errors_total', 3600, 'inc')}) e JOIN ({_inc_sql('requests_total', 3600, 'inc')}) r "
    f"USING (service, window_start)", "request_counters"))
def rate_ratio(spark, sf):
    c = b.request_counters(spark, sf)
    err = ts.counter_rate(c, ["service"], "ts", "errors_total", 3600, tiebreak=["request_id"])
    req = ts.counter_rate(c, ["service"], "ts", "requests_total", 3600, tiebreak=["request_id"])
    r = ts.rate_ratio(err, req, ["service", "window_start"])
    return r.select("service", "window_start", F.round("ratio", 6).alias("ratio"))


# ---- T5 ---------------------------------------------------------------------
_T5_SQL = f"""
SELECT service, day, {rnd('''CASE WHEN total = 0 THEN NULL
                               WHEN le = 'inf'::DOUBLE THEN last_finite
                               ELSE coalesce(lower_le + (le - lower_le) * (0.95 * total - prev_cum)
                                                        / nullif(cum - prev_cum, 0), le) END''', 4)} AS quantile_value
FROM (
  SELECT *, coalesce(prev_le, 0.0) AS lower_le,
         row_number() OVER (PARTITION BY service, day ORDER BY le) AS r
  FROM (
    SELECT service, day, le, cum,
           lag(le) OVER (PARTITION BY service, day ORDER BY le) AS prev_le,
           coalesce(lag(cum) OVER (PARTITION BY service, day ORDER BY le), 0) AS prev_cum,
           max(cum) OVER (PARTITION BY service, day) AS total,
           max(CASE WHEN le <> 'inf'::DOUBLE THEN le END) OVER (PARTITION BY service, day) AS last_finite
    FROM (SELECT service, day, le, sum(bucket_count) AS cum FROM latency_buckets GROUP BY ALL))
  WHERE cum >= 0.95 * total)
WHERE r = 1"""


@query("histogram_quantile", with_views(_T5_SQL, "latency_buckets"))
def histogram_quantile(spark, sf):
    return ts.histogram_quantile(b.latency_buckets(spark, sf), 0.95, ["service", "day"])


# ---- T6 / T7 ----------------------------------------------------------------
@query("agg_by", with_views(
    "SELECT service, sum(v) AS value FROM (SELECT service, arg_max(requests_total, (ts, request_id)) AS v "
    "FROM request_counters GROUP BY service, CAST(ts AS DATE)) GROUP BY service", "request_counters"))
def agg_by(spark, sf):
    c = b.request_counters(spark, sf).withColumn("day", F.to_date("ts")) \
        .withColumn("_order", F.struct("ts", "request_id"))
    return ts.agg_by(c, ["service", "day"], ["service"], "sum", ts="_order", value="requests_total") \
        .withColumnRenamed("requests_total", "value")


@query("max_over_time", with_views(
    "SELECT request_id, service, ts, max(latency_ms) OVER (PARTITION BY service "
    "ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS max_over_time "
    "FROM prediction_log", "prediction_log"))
def max_over_time(spark, sf):
    p = b.prediction_log(spark, sf).select("request_id", "service", "ts", "latency_ms")
    out = ts.trailing_agg(p, ["service"], "ts", "latency_ms", 600, "max", bucket_seconds=3600)
    return out.select("request_id", "service", "ts", "max_over_time")


# ---- T8..T13 ----------------------------------------------------------------
@query("vec_and", with_views(
    "SELECT service, hour, error_share AS value FROM hourly WHERE error_share > 0.2 "
    "AND (service, hour) IN (SELECT (service, hour) FROM hourly WHERE requests >= 5)", "hourly"))
def vec_and(spark, sf):
    h = b.hourly(spark, sf)
    left = h.filter("error_share > 0.2").select("service", "hour", F.col("error_share").alias("value"))
    right = h.filter("requests >= 5").select("service", "hour")
    return ts.vec_and(left, right, ["service", "hour"])


@query("vec_or", with_views(
    "SELECT service, hour, error_share AS value FROM hourly WHERE error_share > 0.3 UNION ALL "
    "SELECT service, hour, CAST(requests AS DOUBLE) FROM hourly WHERE requests >= 8 AND NOT error_share > 0.3",
    "hourly"))
def vec_or(spark, sf):
    h = b.hourly(spark, sf)
    left = h.filter("error_share > 0.3").select("service", "hour", F.col("error_share").alias("value"))
    right = h.filter("requests >= 8").select("service", "hour", F.col("requests").cast("double").alias("value"))
    return ts.vec_or(left, right, ["service", "hour"])


@query("vec_unless", with_views(
    "SELECT service, hour, error_share AS value FROM hourly WHERE error_share > 0.2 AND NOT max_latency > 150",
    "hourly"))
def vec_unless(spark, sf):
    h = b.hourly(spark, sf)
    left = h.filter("error_share > 0.2").select("service", "hour", F.col("error_share").alias("value"))
    right = h.filter("max_latency > 150").select("service", "hour")
    return ts.vec_unless(left, right, ["service", "hour"])


@query("vec_compare", with_views(
    "SELECT service, hour, CAST(errors AS DOUBLE) AS value FROM hourly WHERE errors > requests * 0.25",
    "hourly"))
def vec_compare(spark, sf):
    h = b.hourly(spark, sf)
    left = h.select("service", "hour", F.col("errors").cast("double").alias("value"))
    right = h.select("service", "hour", (F.col("requests") * 0.25).alias("value"))
    return ts.vec_compare(left, right, ["service", "hour"], ">")


@query("absent", with_views(
    "SELECT service, step, 1 AS absent FROM (SELECT DISTINCT 'svc' || CAST(n_nationkey % 6 AS VARCHAR) AS service FROM nation), "
    "(SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS step FROM hourly) "
    "WHERE (service, step) NOT IN (SELECT (service, hour) FROM hourly)", "hourly"))
def absent(spark, sf):
    """Hours without a request of each expected service; each nation has one, and some never report."""
    expected = table(spark, sf, "nation").select(F.concat(F.lit("svc"), (F.col("n_nationkey") % 6).cast("string")).alias("service"))
    return ts.absent_steps(b.prediction_log(spark, sf), ["service"], "ts", 3600, expected)


@query("alert_hold", with_views(
    "SELECT service, min(hour) AS island_start, max(hour) AS island_end, count(*) AS steps, "
    "min(hour) + INTERVAL 7200 SECONDS AS firing_at FROM ("
    "SELECT service, hour, epoch(hour) / 3600 - row_number() OVER (PARTITION BY service ORDER BY hour) AS isl "
    "FROM hourly WHERE error_share > 0.2) GROUP BY service, isl "
    "HAVING epoch(max(hour)) - epoch(min(hour)) >= 7200", "hourly"))
def alert_hold(spark, sf):
    h = b.hourly(spark, sf).withColumn("cond", F.col("error_share") > 0.2)
    return ts.alert_hold(h, ["service"], "hour", "cond", 3600, 7200)


# ---- T15 / T16 --------------------------------------------------------------
# A rule catalog over the request counters
# (alert, metric, series matcher, aggregation, comparison, threshold, hold seconds, severity).
ALERT_RULES = [
    ("ErrorCounterHigh", "errors_total", "svc[01]", "sum", ">", 6.0, 7200, "page"),
    ("RequestCounterLow", "requests_total", ".*", "max", "<", 40.0, 3600, "ticket"),
    ("BusyServices", "requests_total", "svc[23]", "avg", ">=", 20.0, 10800, "info"),
]
RULES_SCHEMA = ("alert string, metric string, matcher string, agg string, op string, threshold double, "
                "hold_s long, severity string")


def _samples(spark, sf):
    c = b.request_counters(spark, sf)
    long = c.select("service", "ts", "request_id", F.inline(F.array(
        F.struct(F.lit("requests_total").alias("metric"), F.col("requests_total").alias("value")),
        F.struct(F.lit("errors_total").alias("metric"), F.col("errors_total").alias("value")))))
    return long


def _rules_sql() -> str:
    rows = ", ".join(f"('{a}', '{m}', '{x}', '{g}', '{o}', CAST({t!r} AS DOUBLE), {h}, '{s}')"
                     for a, m, x, g, o, t, h, s in ALERT_RULES)
    return f"(VALUES {rows}) r(alert, metric, matcher, agg, op, threshold, hold_s, severity)"


_T15_SQL = f"""
WITH inst AS (
  SELECT metric, service, date_trunc('hour', ts) AS step, arg_max(value, (ts, request_id)) AS value FROM (
    SELECT service, ts, request_id, 'requests_total' AS metric, requests_total AS value FROM request_counters
    UNION ALL SELECT service, ts, request_id, 'errors_total', errors_total FROM request_counters)
  GROUP BY ALL),
g AS (
  SELECT r.alert, r.severity, r.op, r.threshold, r.agg, r.hold_s, i.step,
         CASE WHEN r.agg = 'sum' THEN sum(i.value) WHEN r.agg = 'max' THEN max(i.value)
              WHEN r.agg = 'avg' THEN avg(i.value) ELSE CAST(count(i.value) AS DOUBLE) END AS v
  FROM inst i JOIN {_rules_sql()} ON i.metric = r.metric AND regexp_full_match(i.service, r.matcher)
  GROUP BY r.alert, r.severity, r.op, r.threshold, r.agg, r.hold_s, i.step),
c AS (
  SELECT alert, severity, hold_s, step FROM g
  WHERE CASE WHEN op = '>' THEN v > threshold WHEN op = '>=' THEN v >= threshold WHEN op = '<' THEN v < threshold
             WHEN op = '<=' THEN v <= threshold WHEN op = '==' THEN v = threshold ELSE v <> threshold END),
runs AS (
  SELECT alert, severity, hold_s, min(step) AS island_start, max(step) AS island_end, count(*) AS steps FROM (
    SELECT *, epoch(step) / 3600 - row_number() OVER (PARTITION BY alert ORDER BY step) AS isl FROM c)
  GROUP BY alert, severity, hold_s, isl)
SELECT alert, severity, island_start, island_end, steps, island_start + to_seconds(hold_s) AS firing_at
FROM runs WHERE epoch(island_end) - epoch(island_start) >= hold_s"""


@query("alert_catalog", with_views(_T15_SQL, "request_counters"))
def alert_catalog(spark, sf):
    rules = spark.createDataFrame(ALERT_RULES, RULES_SCHEMA)
    return ts.alert_catalog(_samples(spark, sf), rules, "service", 3600,
                            order=F.struct("ts", "request_id"))


# Event-driven autoscaler trigger (2-minute rate, target 80/s, activation 10/s, 2..12 replicas).
TRIGGER = {"window": 120, "target": 80.0, "activation": 10.0, "min": 2, "max": 12}


@query("request_rate_trigger", with_views(
    f"SELECT service, window_start, {rnd('increase / 120.0 * 60', 6)} AS rate_per_min, "
    f"increase / 120.0 * 60 >= 10.0 AS active, "
    f"CAST(least(greatest(ceil(increase / 120.0 * 60 / 80.0), 2), 12) AS BIGINT) AS replicas "
    f"FROM ({_inc_sql('requests_total', 120)})", "request_counters"))
def request_rate_trigger(spark, sf):
    c = b.request_counters(spark, sf)
    r = ts.counter_rate(c, ["service"], "ts", "requests_total", TRIGGER["window"], tiebreak=["request_id"])
    per_min = F.col("rate") * 60
    return r.select("service", "window_start", F.round(per_min, 6).alias("rate_per_min"),
                    (per_min >= TRIGGER["activation"]).alias("active"),
                    F.least(F.greatest(F.ceil(per_min / TRIGGER["target"]), F.lit(TRIGGER["min"])),
                            F.lit(TRIGGER["max"])).cast("long").alias("replicas"))


# ---- R1..R4 -----------------------------------------------------------------
def _slo_ratios(spark, sf):
    """(service, slo, error_ratio): availability from status, latency from p95,
    drift SLOs from the feature-drift verdict (shared by every service) and from the versions a
    service answers with: the share of its requests on versions whose mean score has moved (D4)."""
    log = b.prediction_log(spark, sf)
    err = log.groupBy("service").agg(F.avg((F.col("status") != "success").cast("double")).alias("e"))
    p95 = nearest_rank_percentiles(log, "latency_ms", ["service"], (0.95,), ("p95",))
    from tollgate.plans.lifecycle import _drift
    drift_ok = mon.drift_alert_list(_drift(spark, sf)).select(F.col("passed").alias("drift_ok"))
    moved = mon.prediction_drift_verdict(mon.prediction_drift(log), mon.prediction_drift(log, by=()))
    pred = (log.groupBy("service", "model_version").agg(F.count(F.lit(1)).alias("n")).join(moved, "model_version")
               .groupBy("service").agg((F.sum(F.when(F.col("moved"), F.col("n")).otherwise(0)) / F.sum("n")).alias("moved_share")))
    j = err.join(p95, "service").join(pred, "service").crossJoin(F.broadcast(drift_ok))
    return j.select("service", F.inline(F.array(
        F.struct(F.lit("online_inference_availability").alias("slo"), F.col("e").alias("error_ratio")),
        F.struct(F.lit("online_inference_latency_p95").alias("slo"),
                 F.when(F.col("p95") <= 50.0, 0.0).otherwise(1.0).alias("error_ratio")),
        F.struct(F.lit("feature_drift_clean_window").alias("slo"),
                 F.when(F.col("drift_ok"), 0.0).otherwise(1.0).alias("error_ratio")),
        F.struct(F.lit("prediction_drift_clean_window").alias("slo"), F.col("moved_share").alias("error_ratio")))))


def _slo_ratios_sql() -> str:
    from tollgate.plans.lifecycle import _D3_SQL
    p95 = ("list_sort(list(latency_ms))[least(CAST(round_even((count(*) - 1) * 0.95, 0) AS BIGINT), "
           "count(*) - 1) + 1]")
    return f"""
ratios AS (
  SELECT service, 'online_inference_availability' AS slo, avg(CAST(status <> 'success' AS DOUBLE)) AS error_ratio
  FROM prediction_log GROUP BY service
  UNION ALL SELECT service, 'online_inference_latency_p95',
         CASE WHEN {rnd(p95, 4)} <= 50.0 THEN 0.0 ELSE 1.0 END FROM prediction_log GROUP BY service
  UNION ALL SELECT s.service, 'feature_drift_clean_window', CASE WHEN d.ok THEN 0.0 ELSE 1.0 END
  FROM (SELECT DISTINCT service FROM prediction_log) s, (SELECT NOT bool_or(flagged) AS ok FROM ({_D3_SQL})) d
  UNION ALL SELECT service, 'prediction_drift_clean_window', avg(CAST(moved AS DOUBLE)) FROM prediction_log JOIN (
    SELECT model_version, abs({rnd('v.m - a.m', 6)}) > {mon.SCORE_DRIFT_LIMIT!r} AS moved
    FROM (SELECT model_version, {rnd('avg(churn_score)', 6)} AS m FROM prediction_log GROUP BY 1) v,
         (SELECT {rnd('avg(churn_score)', 6)} AS m FROM prediction_log) a) USING (model_version) GROUP BY service),
targets AS (SELECT * FROM (VALUES {", ".join(f"('{n}', CAST({t} AS DOUBLE), '{o}')" for n, t, o in slo.SLO_TARGETS)})
            t(slo, target, owner)),
st AS (
  SELECT service, slo, target, owner, {rnd('error_ratio', 6)} AS error_ratio,
         {rnd('error_ratio / greatest(1.0 - target, 1e-4)', 4)} AS burn_rate,
         {rnd('greatest(0.0, 100.0 * (1.0 - error_ratio / greatest(1.0 - target, 1e-4)))', 2)}
           AS remaining_error_budget_pct
  FROM ratios JOIN targets USING (slo))"""


_STATUS = ("CASE WHEN burn_rate >= 14.4 THEN 'page' WHEN burn_rate >= 6.0 THEN 'hold_release' "
           "WHEN burn_rate >= 1.0 THEN 'ticket' ELSE 'healthy' END")
_ACTION = ("CASE WHEN max_burn_rate >= 14.4 THEN 'freeze_promotion_and_page' "
           "WHEN max_burn_rate >= 6.0 THEN 'hold_canary_and_open_incident' "
           "WHEN max_burn_rate >= 1.0 THEN 'create_ticket_before_next_release' ELSE 'allow_release' END")
_SLO_VIEWS = ("prediction_log", "churn_split", "churn_current")


@query("burn_rate", with_views(
    f"WITH {_slo_ratios_sql()} SELECT service, slo, burn_rate, remaining_error_budget_pct FROM st", *_SLO_VIEWS))
def burn_rate(spark, sf):
    st = slo.slo_status(_slo_ratios(spark, sf), slo.slo_targets(spark), ["service"])
    return st.select("service", "slo", "burn_rate", "remaining_error_budget_pct")


@query("slo_status", with_views(
    f"WITH {_slo_ratios_sql()} SELECT *, {_STATUS} AS status FROM st", *_SLO_VIEWS))
def slo_status(spark, sf):
    return slo.slo_status(_slo_ratios(spark, sf), slo.slo_targets(spark), ["service"])


@query("slo_action", with_views(
    f"WITH {_slo_ratios_sql()} SELECT service, max_burn_rate, {_ACTION} AS recommended_action, "
    f"({_ACTION}) IN ('freeze_promotion_and_page', 'hold_canary_and_open_incident') AS release_freeze "
    f"FROM (SELECT service, max(burn_rate) AS max_burn_rate FROM st GROUP BY service)", *_SLO_VIEWS))
def slo_action(spark, sf):
    st = slo.slo_status(_slo_ratios(spark, sf), slo.slo_targets(spark), ["service"])
    return slo.slo_action(st, ["service"])


def _r4_sql() -> str:
    cols = []
    for name, short_s, long_s, limit in slo.MULTIWINDOW:
        fl = []
        for span in (short_s, long_s):
            w = f"(PARTITION BY service ORDER BY m RANGE BETWEEN {span // 60 - 1} PRECEDING AND CURRENT ROW)"
            fl.append(f"(sum(err) OVER {w} / sum(req) OVER {w}) / 0.005 > {limit}")
        cols.append(f"({fl[0]}) AND ({fl[1]}) AS {name}")
    agg = ", ".join([f"count(*) FILTER (WHERE {n}) AS {n}_minutes" for n, *_ in slo.MULTIWINDOW]
                    + [f"min(m) FILTER (WHERE {n}) AS {n}_first_minute" for n, *_ in slo.MULTIWINDOW])
    return f"""
SELECT service, count(*) AS active_minutes, {agg} FROM (
  SELECT service, m, {", ".join(cols)} FROM (
    SELECT service, CAST(floor(floor(epoch(ts)) / 60) AS BIGINT) AS m, count(*) AS req,
           count(*) FILTER (WHERE status <> 'success') AS err
    FROM prediction_log GROUP BY ALL))
GROUP BY service"""


@query("multiwindow_burn", with_views(_r4_sql(), "prediction_log"))
def multiwindow_burn(spark, sf):
    return slo.multiwindow_burn(b.prediction_log(spark, sf), ["service"])
