"""Streaming queries (W1-W10): each runs a Structured Streaming job to completion
(``availableNow``) and returns the sink table; oracles are the batch twins."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from tollgate.operators import model as mdl
from tollgate.plans.catalog import query
from tollgate.plans.sqlviews import rnd, sig, with_views
from tollgate.session import checkpoint_root
from tollgate.sources import bindings as b
from tollgate.sources.tables import table
from tollgate.streaming import jobs as J

DELAY = "10 minutes"
MAX_EV = "(SELECT max(ts) FROM events)"


def _ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@query("stream_score", with_views("""
SELECT p.request_id, p.ts, p.model_version AS version, s.churn_score, s.prediction AS high_risk
FROM prediction_log p LEFT JOIN scored s ON s.c_custkey = p.user_id AND s.version = p.model_version""", "prediction_log", "scored"))
def stream_score(spark, sf):
    """Requests are scored with their customer's features by the version they are routed to; a batch that runs again adds nothing."""
    requests = b.to_prediction_log(J.table_stream(spark, sf, "events")).select("request_id", "ts", "user_id", F.col("model_version").alias("version"))
    rows = b.churn_split(spark, sf)

    def score(batch, _):
        return J.stream_score(batch, rows, mdl.model_table(spark, rows.filter(F.col("split") == "train")))

    return _ntz(J.run_foreach_batch(requests, "stream_score", score).drop("batch_id"), "ts")


@query("stream_dedupe", "SELECT DISTINCT event_id, event_type FROM events")
def stream_dedupe(spark, sf):
    """The error events arrive twice (two sources); duplicates within 120 s are dropped."""
    s = J.table_stream(spark, sf, "events")
    dup = J.table_stream(spark, sf, "events").filter(F.col("event_type") == "error")
    out, _ = J.run_append(J.stream_dedupe(s.unionByName(dup)).select("event_id", "event_type"), "stream_dedupe")
    return out


def _closed(we: str, max_ts: str = MAX_EV, delay: str = DELAY) -> str:
    return f"{we} <= {max_ts} - INTERVAL {delay}"


@query("stream_tumbling_slo", with_views(f"""
SELECT window_start, window_end, service, requests, errors, {rnd('errors / requests', 6)} AS error_ratio FROM (
  SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS window_start, time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES AS window_end,
         service, count(*) AS requests, count(*) FILTER (WHERE status <> 'success') AS errors
  FROM prediction_log GROUP BY ALL) WHERE {_closed('window_end')}""", "prediction_log"))
def stream_tumbling_slo(spark, sf):
    log = b.to_prediction_log(J.table_stream(spark, sf, "events"))
    out, _ = J.run_append(J.stream_window_slo(log, ["service"], "5 minutes", delay=DELAY), "stream_tumbling_slo")
    return _ntz(out, "window_start", "window_end")


@query("stream_sliding_rate", with_views(f"""
SELECT window_start, window_end, service, count(*) AS requests, count(*) FILTER (WHERE status <> 'success') AS errors,
       {rnd("count(*) FILTER (WHERE status <> 'success') / count(*)", 6)} AS error_ratio FROM (
  SELECT time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL (k * 5) MINUTES AS window_start,
         time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL (k * 5) MINUTES + INTERVAL 1 HOUR AS window_end, service, status
  FROM prediction_log, range(0, 12) r(k))
WHERE {_closed('window_end')} GROUP BY window_start, window_end, service""", "prediction_log"))
def stream_sliding_rate(spark, sf):
    log = b.to_prediction_log(J.table_stream(spark, sf, "events"))
    out, _ = J.run_append(J.stream_window_slo(log, ["service"], "1 hour", "5 minutes", delay=DELAY),
                          "stream_sliding_rate")
    return _ntz(out, "window_start", "window_end")


# Watcher lag budgets (seconds) per asset.
LAG_BUDGETS = [("raw", 120), ("candidate", 60), ("canary", 90)]


@query("stream_watcher_lag", with_views(f"""
WITH b(asset, budget_s) AS (VALUES {", ".join(f"('{a}', {s})" for a, s in LAG_BUDGETS)}),
l AS (SELECT asset, CAST(floor(epoch((SELECT max(ts) FROM asset_events))) - floor(epoch(max(ts))) AS BIGINT) AS lag_s FROM asset_events GROUP BY asset)
SELECT asset, lag_s, budget_s, CASE WHEN lag_s IS NULL THEN false ELSE lag_s <= budget_s END AS within_budget FROM l FULL JOIN b USING (asset)""", "asset_events"))
def stream_watcher_lag(spark, sf):
    """The stream's last report; state holds each asset's last event over all micro-batches."""
    budgets = spark.createDataFrame(LAG_BUDGETS, "asset string, budget_s int")
    assets = b.to_asset_events(J.table_stream(spark, sf, "events"))
    out = J.run_foreach_batch(J.stream_last_seen(assets), "stream_watcher_lag", lambda df, _: J.watcher_lag(df, budgets), mode="complete")
    last = out.agg(F.max("batch_id").alias("batch_id"))
    return out.join(F.broadcast(last), "batch_id").drop("batch_id").withColumn("lag_s", F.col("lag_s").cast("long"))


@query("stream_deadline", f"""
WITH a AS (SELECT event_id AS a_id, user_id, ts AS a_ts FROM events WHERE event_type = 'click'),
     b AS (SELECT event_id AS b_id, user_id, ts AS b_ts FROM events WHERE event_type = 'purchase'),
     m AS (SELECT a_id, b_id FROM a JOIN b ON a.user_id = b.user_id AND b_ts >= a_ts AND b_ts <= a_ts + INTERVAL 30 MINUTES),
     wm AS (SELECT least((SELECT max(a_ts) FROM a), (SELECT max(b_ts) FROM b)) - INTERVAL 1 HOUR AS w)
SELECT a_id, b_id FROM m
UNION ALL SELECT a_id, NULL FROM a WHERE a_id NOT IN (SELECT a_id FROM m)
  AND a_ts < (SELECT w FROM wm) - INTERVAL 30 MINUTES""")
def stream_deadline(spark, sf):
    """Clicks without a purchase by the same user within 30 minutes (stream-stream left outer join)."""
    e = J.table_stream(spark, sf, "events")
    a = e.filter(F.col("event_type") == "click").select(F.col("event_id").alias("a_id"),
                                                        F.col("user_id").alias("a_key"), F.col("ts").alias("a_ts"))
    bb = e.filter(F.col("event_type") == "purchase").select(F.col("event_id").alias("b_id"),
                                                           F.col("user_id").alias("b_key"), F.col("ts").alias("b_ts"))
    out, _ = J.run_append(J.stream_deadline(a, bb, "user_id", "30 minutes").select("a_id", "b_id"), "stream_deadline")
    return out


HOLD_S = 300


@query("stream_alert_hold", with_views(f"""
WITH steps AS (SELECT service, date_trunc('minute', ts) AS step, bool_and(latency_ms > 50) AS c FROM prediction_log GROUP BY ALL),
r AS (SELECT service, step, c, sum(CASE WHEN c THEN 0 ELSE 1 END) OVER (PARTITION BY service ORDER BY step ROWS UNBOUNDED PRECEDING) AS g
      FROM steps WHERE {_closed('step + INTERVAL 1 MINUTE')}),
i AS (SELECT service, step, min(step) OVER (PARTITION BY service, g) AS s FROM r WHERE c)
SELECT service, s AS island_start, min(step) AS fired_at FROM i
WHERE epoch(step) - epoch(s) >= {HOLD_S} GROUP BY service, s""", "prediction_log"))
def stream_alert_hold(spark, sf):
    """A service alerts once its requests have been slow (> 50 ms) for 5 minutes of one-minute steps."""
    log = b.to_prediction_log(J.table_stream(spark, sf, "events")).withColumn("slow", F.col("latency_ms") > 50)
    return _ntz(J.run_alert_hold(log, "slow", HOLD_S, "stream_alert_hold", delay=DELAY), "island_start", "fired_at")


@query("stream_asset_trigger", with_views(f"""
SELECT window_start, has_raw, has_candidate, has_rollback, (has_raw AND has_candidate) OR has_rollback AS fires FROM (
  SELECT date_trunc('hour', ts) AS window_start, bool_or(asset = 'raw') AS has_raw, bool_or(asset = 'candidate') AS has_candidate,
         bool_or(asset = 'rollback_request') AS has_rollback FROM asset_events GROUP BY 1)
WHERE {_closed('window_start + INTERVAL 1 HOUR', '(SELECT max(ts) FROM asset_events)')}""", "asset_events"))
def stream_asset_trigger(spark, sf):
    assets = b.to_asset_events(J.table_stream(spark, sf, "events"))
    out, _ = J.run_append(J.stream_asset_trigger(assets, DELAY), "stream_asset_trigger")
    return _ntz(out, "window_start")


@query("stream_drift", with_views(f"""
SELECT window_start, service, {rnd('m', 4)} AS window_mean, {rnd('m - r', 4)} AS delta, abs({rnd('m - r', 4)}) > 20.0 AS flagged
FROM (SELECT date_trunc('hour', ts) AS window_start, service, avg(latency_ms) AS m FROM prediction_log GROUP BY ALL)
JOIN (SELECT service, avg(latency_ms) AS r FROM prediction_log GROUP BY service) USING (service)
WHERE {_closed('window_start + INTERVAL 1 HOUR')}""", "prediction_log"))
def stream_drift(spark, sf):
    ref = b.prediction_log(spark, sf).groupBy("service").agg(F.avg("latency_ms").alias("reference_mean"))
    log = b.to_prediction_log(J.table_stream(spark, sf, "events"))
    out, _ = J.run_append(J.stream_drift(log, ref, ["service"], "latency_ms", delay=DELAY), "stream_drift")
    return _ntz(out, "window_start")


LATE_CUTOFF = _dt.datetime(2024, 1, 4)
SECOND_PART = _dt.datetime(2024, 1, 18)


@query("late_data", f"""
WITH main AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-04'),
     wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM main)
SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events,
       any_value((SELECT count(*) FROM (SELECT DISTINCT date_trunc('day', ts), event_type FROM events
                                        WHERE ts < TIMESTAMP '2024-01-04'))) AS late_groups_dropped
FROM main GROUP BY 1, 2 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= any_value((SELECT w FROM wm))""")
def late_data(spark, sf):
    """Events arrive as three micro-batches -- days 4-17, days 18-30, then days 1-3.

    By the third batch the watermark (1 hour behind the newest event of the
    previous batches) is far past days 1-3, so those rows are dropped as late
    and counted from the query progress (``numRowsDroppedByWatermark`` counts
    the late (window, key) groups reaching the state store after the per-key
    merge, i.e. distinct late groups -- independent of partitioning).
    The three parts are written by Spark from ``events`` into the shared
    checkpoint folder, each round-robin into the same number of files, and
    ``maxFilesPerTrigger`` makes each write one micro-batch (files are taken
    in modification order).
    """
    folder = f"{checkpoint_root(spark)}/late-data-{uuid.uuid4().hex[:12]}"
    k = max(1, spark.sparkContext.defaultParallelism)
    e = table(spark, sf, "events")
    ts = F.col("ts")
    for part in (e.filter((ts >= F.lit(LATE_CUTOFF)) & (ts < F.lit(SECOND_PART))), e.filter(ts >= F.lit(SECOND_PART)),
                 e.filter(ts < F.lit(LATE_CUTOFF))):
        part.repartition(k).write.mode("append").parquet(folder)
    s = J.table_stream(spark, sf, "events", max_files=k, folder=folder)
    agg = (s.withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 day").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("window_start"), "event_type", "events"))
    out, progress = J.run_append(agg, "late_data")
    return _ntz(out, "window_start").withColumn("late_groups_dropped",
                                                    F.lit(progress["dropped_by_watermark"]).cast("long"))
