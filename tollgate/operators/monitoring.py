"""Monitoring: latency percentiles, feature and prediction drift, recent rows.

Sources are the prediction log and the reference / current feature tables.
Every aggregate is grouped (service, model version, ...) so one job
monitors many services.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.functions.exprs import blank_to_null
from tollgate.functions.guards import bounded_broadcast
from tollgate.functions.ranking import nearest_rank_percentiles

FEATURES = ("tenure_months", "monthly_spend", "support_tickets", "late_payments", "usage_drop_pct")

# Absolute drift limits (monthly_spend 20.0, every other feature 0.25).
DRIFT_LIMITS = {"monthly_spend": 20.0}
DEFAULT_DRIFT_LIMIT = 0.25
#: Largest difference of a version's mean score from that of all predictions.
SCORE_DRIFT_LIMIT = 0.005
HIGH_RISK_SCORE = 0.5
RECENT_LIMIT = 20


def latency_percentiles(log: DataFrame, by: Sequence[str] = ("service",), value: str = "latency_ms") -> DataFrame:
    """p50/p95/p99 nearest rank per group (empty -> 0.0)."""
    return nearest_rank_percentiles(log, value, by, (0.5, 0.95, 0.99), ("p50", "p95", "p99"))


def feature_means(df: DataFrame, features: Sequence[str] = FEATURES, by: Sequence[str] = ()) -> DataFrame:
    """Per-feature mean ignoring null/blank (round 4), long form (feature, mean)."""
    aggs = [F.avg(blank_to_null(f).cast("string").try_cast("double")).alias(f) for f in features]
    wide = df.groupBy(*by).agg(*aggs)
    items = F.array(*[F.struct(F.lit(f).alias("feature"), F.round(F.coalesce(F.col(f), F.lit(0.0)), 4).alias("mean"))
                      for f in features])
    return wide.select(*by, F.inline(items))


def drift_limits(spark: SparkSession, features: Sequence[str] = FEATURES) -> DataFrame:
    return spark.createDataFrame([(f, float(DRIFT_LIMITS.get(f, DEFAULT_DRIFT_LIMIT))) for f in features],
                                 "feature string, limit double")


def feature_drift(reference: DataFrame, current: DataFrame, limits: DataFrame,
                  features: Sequence[str] = FEATURES) -> DataFrame:
    """D3: current - reference mean per feature; flagged when |delta| > limit.

    Falls back to the reference when the current set is empty.  Both sides are
    one row per feature after aggregation, so the join is tiny.
    """
    ref = feature_means(reference, features).withColumnRenamed("mean", "reference_mean")
    cur_wide = current.agg(F.count(F.lit(1)).alias("_n"),
                           *[F.avg(blank_to_null(f).cast("string").try_cast("double")).alias(f) for f in features])
    cur = cur_wide.select("_n", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.round(F.coalesce(F.col(f), F.lit(0.0)), 4).alias("current_mean"))
        for f in features])))
    cur = bounded_broadcast(cur, len(features), "one current mean per feature")
    j = ref.join(cur, "feature").join(bounded_broadcast(limits, 10_000, "drift limits"), "feature", "left")
    cm = F.when(F.col("_n") > 0, F.col("current_mean")).otherwise(F.col("reference_mean"))
    delta = F.round(cm - F.col("reference_mean"), 4)
    lim = F.coalesce(F.col("limit"), F.lit(DEFAULT_DRIFT_LIMIT))
    return j.select("feature", "reference_mean", cm.alias("current_mean"), delta.alias("delta"),
                    lim.alias("limit"), (F.abs(delta) > lim).alias("flagged"))


def drift_alert_list(drift: DataFrame) -> DataFrame:
    """Sorted names of flagged features (comma-joined) and the overall pass flag."""
    return drift.agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("flagged"), F.col("feature")))), ",")
                     .alias("alerts"),
                     (~F.bool_or("flagged")).alias("passed"))


def prediction_drift(log: DataFrame, by: Sequence[str] = ("model_version",), score: str = "churn_score") -> DataFrame:
    """Mean score (round 6) and share >= 0.5 (round 4)."""
    return log.groupBy(*by).agg(
        F.round(F.avg(score), 6).alias("mean_score"),
        F.round(F.avg((F.col(score) >= HIGH_RISK_SCORE).cast("double")), 4).alias("high_risk_share"),
        F.count(F.lit(1)).alias("predictions"))


def prediction_drift_verdict(by_version: DataFrame, overall: DataFrame, limit: float = SCORE_DRIFT_LIMIT) -> DataFrame:
    """Versions whose mean score lies further from the mean of all predictions than the limit."""
    whole = overall.select(F.col("mean_score").alias("overall"))       # one row
    return by_version.crossJoin(F.broadcast(whole)).select("model_version", (F.abs(F.round(F.col("mean_score") - F.col("overall"), 6)) > limit).alias("moved"))


def recent_predictions(log: DataFrame, by: Sequence[str] = ("service",), k: int = RECENT_LIMIT,
                       order: Sequence[Column] | None = None) -> DataFrame:
    """Last k rows per group by log order (ts, request_id).

    ``row_number() <= k`` is planned with a partial window-group-limit before
    the shuffle, so a hot group sends at most k rows per map task.
    """
    order = order or [F.col("ts").desc(), F.col("request_id").desc()]
    w = Window.partitionBy(*by).orderBy(*order)
    return log.withColumn("recency_rank", F.row_number().over(w)).filter(F.col("recency_rank") <= k)


def active_version(log: DataFrame, by: Sequence[str] = ("service",)) -> DataFrame:
    """Model version on the latest record ('unknown' if none)."""
    latest = F.max_by("model_version", F.struct("ts", "request_id"))
    return log.groupBy(*by).agg(F.coalesce(latest, F.lit("unknown")).alias("active_version"))


def throughput_error_rate(log: DataFrame, by: Sequence[str] = ("service",)) -> DataFrame:
    """Prediction count and error share computed from status."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.round(F.avg((F.col("status") != "success").cast("double")), 6).alias("error_rate"))
