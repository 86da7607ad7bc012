"""SLO error budgets: burn rate, status, action, multi-window burn alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.functions.exprs import epoch_seconds_ntz
from tollgate.functions.guards import bounded_broadcast

# Burn-rate tiers (status and action) and the four SLO targets.
BURN_TIERS = [(14.4, "page", "freeze_promotion_and_page"),
              (6.0, "hold_release", "hold_canary_and_open_incident"),
              (1.0, "ticket", "create_ticket_before_next_release")]
HEALTHY = ("healthy", "allow_release")
SLO_TARGETS = [
    ("online_inference_availability", 0.995, "serving"),
    ("online_inference_latency_p95", 0.99, "serving"),
    ("feature_drift_clean_window", 0.95, "data-quality"),
    ("prediction_drift_clean_window", 0.95, "ml-platform"),
]
# Multi-window policy (name, short window s, long window s, burn limit).
MULTIWINDOW = [("fast_page", 300, 3600, 14.4), ("slow_page", 1800, 21600, 6.0), ("ticket", 21600, 259200, 1.0)]


def burn_rate(error_ratio: Column, target: Column) -> Column:
    """error_ratio / max(1 - target, 1e-4), round 4."""
    return F.round(error_ratio / F.greatest(F.lit(1.0) - target, F.lit(1e-4)), 4)


def remaining_budget_pct(error_ratio: Column, target: Column) -> Column:
    budget = F.greatest(F.lit(1.0) - target, F.lit(1e-4))
    return F.round(F.greatest(F.lit(0.0), 100.0 * (1.0 - error_ratio / budget)), 2)


def _tier(burn: Column, idx: int, default: str) -> Column:
    expr = None
    for limit, *names in BURN_TIERS:
        expr = (F.when(burn >= limit, names[idx]) if expr is None else expr.when(burn >= limit, names[idx]))
    return expr.otherwise(default)


def slo_targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SLO_TARGETS, "slo string, target double, owner string")


def slo_status(ratios: DataFrame, targets: DataFrame, by: Sequence[str]) -> DataFrame:
    """R2: (entity, slo, error_ratio) x targets -> burn, remaining budget, status."""
    j = ratios.join(bounded_broadcast(targets, 1_000, "slo targets"), "slo", "inner")
    burn = burn_rate(F.col("error_ratio"), F.col("target"))
    return j.select(*by, "slo", "target", "owner", F.round("error_ratio", 6).alias("error_ratio"),
                    burn.alias("burn_rate"),
                    remaining_budget_pct(F.col("error_ratio"), F.col("target")).alias("remaining_error_budget_pct"),
                    _tier(burn, 0, HEALTHY[0]).alias("status"))


def slo_action(status: DataFrame, by: Sequence[str]) -> DataFrame:
    """Max burn per entity -> recommended action and release freeze."""
    g = status.groupBy(*by).agg(F.max("burn_rate").alias("max_burn_rate"))
    action = _tier(F.col("max_burn_rate"), 1, HEALTHY[1])
    return g.select(*by, "max_burn_rate", action.alias("recommended_action"),
                    action.isin(BURN_TIERS[0][2], BURN_TIERS[1][2]).alias("release_freeze"))


def multiwindow_burn(log: DataFrame, by: Sequence[str], ts: str = "ts", target: float = 0.995) -> DataFrame:
    """Per minute, burn over each short and long window; a tier fires when both exceed it.

    Requests are first pre-aggregated to (entity, minute) -- bounded by the
    minutes in the period per entity.  A trailing-window sum over
    [t - w + 1, t] is computed as the difference of two unbounded-preceding
    range sums, (-inf, t] minus (-inf, t - w]; Spark evaluates those
    incrementally (O(n) per entity) instead of re-summing every sliding frame.
    """
    m = (log.withColumn("_min", F.floor(epoch_seconds_ntz(ts) / 60).cast("long"))
            .groupBy(*by, "_min").agg(F.count(F.lit(1)).alias("req"),
                                      F.count_if(F.col("status") != "success").alias("err")))
    budget = max(1.0 - target, 1e-4)
    base = Window.partitionBy(*by).orderBy("_min")
    upto_now = base.rangeBetween(Window.unboundedPreceding, 0)

    def trailing(col: str, minutes: int) -> Column:
        before = base.rangeBetween(Window.unboundedPreceding, -minutes)
        return F.sum(col).over(upto_now) - F.coalesce(F.sum(col).over(before), F.lit(0))

    cols = []
    for name, short_s, long_s, limit in MULTIWINDOW:
        flags = []
        for span in (short_s, long_s):
            ratio = trailing("err", span // 60) / trailing("req", span // 60)
            flags.append(ratio / budget > limit)
        cols.append((flags[0] & flags[1]).alias(name))
    per_min = m.select(*by, "_min", *cols)
    return per_min.groupBy(*by).agg(
        F.count(F.lit(1)).alias("active_minutes"),
        *[F.count_if(F.col(n)).alias(f"{n}_minutes") for n, *_ in MULTIWINDOW],
        *[F.min(F.when(F.col(n), F.col("_min"))).alias(f"{n}_first_minute") for n, *_ in MULTIWINDOW])
