"""Evaluation: confusion metrics, segment accuracy, threshold search, gates.

All metrics are a single grouped aggregate over scored rows (map-side
partial aggregation), keyed by (model, version, split) so many models and
versions are evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.functions.guards import bounded_broadcast

EVAL_KEYS = ("model", "version", "split")

# Offline evaluation gates (name, metric, direction, threshold).
GATES = [
    ("data_quality_gate", "data_quality_passed", "min", 1.0),
    ("min_accuracy", "accuracy", "min", 0.70),
    ("min_f1", "f1", "min", 0.62),
    ("max_brier_score", "brier_score", "max", 0.24),
    ("segment_accuracy_gap", "segment_accuracy_gap", "max", 0.18),
    ("latency_gate_p95_ms", "latency_p95_ms", "max", 50.0),
]

# Threshold search grid 0.20..0.60 step 0.01 and objective weights.
THRESHOLD_STEPS = range(20, 61)
OBJ_ACCURACY_W = 0.15
OBJ_GAP_W = 0.05


def _ratios(df: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision = tp / F.greatest(tp + fp, F.lit(1))
    recall = tp / F.greatest(tp + fn, F.lit(1))
    f1 = 2 * precision * recall / F.greatest(precision + recall, F.lit(1e-9))
    return (df.withColumn("accuracy", F.round((tp + tn) / F.greatest(tp + fp + tn + fn, F.lit(1)), 4))
              .withColumn("precision", F.round(precision, 4))
              .withColumn("recall", F.round(recall, 4))
              .withColumn("f1", F.round(f1, 4)))


def confusion_metrics(scored: DataFrame, label: str = "churned", by: Sequence[str] = EVAL_KEYS) -> DataFrame:
    """M4: tp/fp/tn/fn, precision, recall, f1 (floor 1e-9), accuracy, Brier, mean score."""
    p, y = F.col("prediction"), F.col(label)
    g = scored.groupBy(*by).agg(
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
        F.count_if((p == 0) & (y != 0)).alias("fn"),
        F.sum(F.pow(F.col("churn_score") - y, 2)).alias("_sq"),
        F.sum("churn_score").alias("_ssum"),
        F.count(F.lit(1)).alias("rows"),
    )
    n = F.greatest(F.col("rows"), F.lit(1))
    return (_ratios(g)
            .withColumn("brier_score", F.round(F.col("_sq") / n, 4))
            .withColumn("mean_score", F.round(F.col("_ssum") / n, 6))
            .drop("_sq", "_ssum"))


def segment_confusion(scored: DataFrame, label: str = "churned", segment: str = "segment",
                      by: Sequence[str] = EVAL_KEYS) -> DataFrame:
    """Confusion counts and score sums per (group, segment): the one pass that
    both M4 metrics and M5 segment accuracy are rolled up from."""
    p, y = F.col("prediction"), F.col(label)
    return scored.groupBy(*by, segment).agg(
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
        F.count_if((p == 0) & (y != 0)).alias("fn"),
        F.sum(F.pow(F.col("churn_score") - y, 2)).alias("_sq"),
        F.sum("churn_score").alias("_ssum"),
        F.count(F.lit(1)).alias("rows"),
    )


def metrics_from_segments(seg: DataFrame, segment: str = "segment", by: Sequence[str] = EVAL_KEYS) -> DataFrame:
    """M4 + M5 gap from ``segment_confusion`` (tiny input: groups x segments)."""
    acc = F.round((F.col("tp") + F.col("tn")) / F.greatest(F.col("rows"), F.lit(1)), 4)
    g = seg.withColumn("_acc", acc).groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn", "_sq", "_ssum", "rows")],
        F.round(F.max("_acc") - F.min("_acc"), 4).alias("segment_accuracy_gap"))
    n = F.greatest(F.col("rows"), F.lit(1))
    return (_ratios(g)
            .withColumn("brier_score", F.round(F.col("_sq") / n, 4))
            .withColumn("mean_score", F.round(F.col("_ssum") / n, 6))
            .drop("_sq", "_ssum"))


def segment_accuracy(scored: DataFrame, label: str = "churned", segment: str = "segment",
                     by: Sequence[str] = EVAL_KEYS) -> DataFrame:
    """M5: accuracy per segment (round 4) and the max-min gap per group (long form)."""
    seg = scored.groupBy(*by, segment).agg(
        F.round(F.avg((F.col("prediction") == F.col(label)).cast("double")), 4).alias("accuracy"))
    gap = seg.groupBy(*by).agg(F.round(F.max("accuracy") - F.min("accuracy"), 4).alias("segment_accuracy_gap"))
    gap = bounded_broadcast(gap, 100_000, "one gap per evaluated group")
    return seg.join(gap, list(by), "left") if by else seg.crossJoin(gap)


def threshold_search(scored: DataFrame, spark: SparkSession, label: str = "churned",
                     segment: str = "segment", by: Sequence[str] = ("model", "version")) -> DataFrame:
    """M6: pick the threshold maximising f1 + .15*acc - .05*gap (rounded metrics; ties -> lowest).

    Scores carry 6 decimals, so ``score >= s/100`` is exactly
    ``floor(round(score * 1e6) / 1e4) >= s``: every row falls into one grid bin
    (19 = below the grid).  One partial aggregate counts labels per
    (group, segment, bin); a generated spine (sequence 20..60 per group) fills
    empty bins; suffix sums over at most 42 bins give tp/fp for every
    threshold.  No join with the grid and no per-threshold pass.
    """
    lo, hi = THRESHOLD_STEPS[0], THRESHOLD_STEPS[-1]
    y = F.col(label)
    micro = F.round(F.col("churn_score") * 1_000_000).cast("long")
    k = F.least(F.greatest(F.floor(micro / 10_000), F.lit(lo - 1)), F.lit(hi)).cast("int")
    bins = scored.groupBy(*by, segment, k.alias("k")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"), F.count_if(y != 0).alias("nz"))
    spine = (bins.select(*by, segment).distinct()
                 .select(*by, segment, F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("k"))
                 .select(*by, segment, "k", *[F.lit(0).cast("long").alias(c) for c in ("pos", "neg", "nz")]))
    full = bins.unionByName(spine).groupBy(*by, segment, "k").agg(
        *[F.sum(c).alias(c) for c in ("pos", "neg", "nz")])
    tot = Window.partitionBy(*by, segment)
    ge = tot.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_seg = (full.withColumn("tp", F.sum("pos").over(ge)).withColumn("fp", F.sum("neg").over(ge))
                   .withColumn("tn", F.sum("neg").over(tot) - F.col("fp"))
                   .withColumn("fn", F.sum("nz").over(tot) - F.sum("nz").over(ge))
                   .filter(F.col("k") >= lo)
                   .withColumn("threshold", F.col("k") / 100.0))
    keys = [*by, "threshold"]
    seg_acc = F.round((F.col("tp") + F.col("tn")) / F.greatest(F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"),
                                                                  F.lit(1)), 4)
    agg = per_seg.withColumn("seg_acc", seg_acc).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")],
        F.round(F.max("seg_acc") - F.min("seg_acc"), 4).alias("segment_accuracy_gap"))
    m = _ratios(agg).withColumn(
        "objective", F.col("f1") + OBJ_ACCURACY_W * F.col("accuracy") - OBJ_GAP_W * F.col("segment_accuracy_gap"))
    w = Window.partitionBy(*by).orderBy(F.col("objective").desc(), F.col("threshold").asc())
    return (m.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
             .select(*by, F.round("threshold", 2).alias("threshold"), "f1", "accuracy", "segment_accuracy_gap",
                     F.round("objective", 6).alias("objective")))


def gate_policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GATES, ["gate", "metric", "direction", "threshold"])


def evaluation_gates(metrics_long: DataFrame, policy: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M7: metrics as (by..., metric, value) rows -> one row per gate; missing -> fail.

    The policy is the spine (a right join onto the tiny gate table): every gate
    appears once per entity even when its metric is absent.
    """
    entities = metrics_long.select(*by).distinct() if by else None
    spine = (entities.crossJoin(bounded_broadcast(policy, 1_000, "gate policy"))
             if entities is not None else policy)
    # metrics: one row per (entity, metric) -- entities are registered model versions
    j = spine.join(bounded_broadcast(metrics_long, 100_000, "metrics per version"), [*by, "metric"], "left")
    v, t = F.col("value"), F.col("threshold")
    passed = F.coalesce(F.when(F.col("direction") == "min", v >= t).otherwise(v <= t), F.lit(False))
    return j.select(*by, "gate", "metric", F.col("value").alias("observed"), "threshold", passed.alias("passed"))


def metrics_to_long(metrics: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    items = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return metrics.select(*by, F.inline(items))
