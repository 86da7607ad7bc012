"""Feature statistics, standardisation and logistic scoring as column expressions.

A model is a row of a model table (model, version, bias, w_<feature>,
enterprise_adj, threshold, mean_<feature>, std_<feature>).  Scoring joins the
rows to be scored with the (tiny, size-checked) model table, so several models
and versions score in one projection, inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.exprs import clipped_sigmoid
from tollgate.functions.guards import bounded_broadcast

FEATURES = ("tenure_months", "monthly_spend", "support_tickets", "late_payments", "usage_drop_pct")

# Registered model versions (weights found by fitting the
# regularised logistic objective on the train split; see M1 train_logistic).
REGISTERED_MODELS = [
    # model, version, role, bias, tenure, spend, tickets, late, usage, enterprise_adj, threshold
    ("churn-risk", "2026.07.0", "champion", -0.258, -0.069, 0.033, 0.334, 0.763, 1.278, -0.486, 0.32),
    ("churn-risk", "2026.07.1", "challenger", -0.261, -0.069, 0.033, 0.333, 0.763, 1.278, -0.479, 0.32),
]
DEFAULT_ENTERPRISE_ADJ = -0.25
DEFAULT_THRESHOLD = 0.5


def cast_features(df: DataFrame, features: Sequence[str] = FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """Project and cast the features to double (strings go through try_cast)."""
    return df.select(*keep, *[F.col(f).try_cast("double").alias(f) for f in features])


def feature_stats(df: DataFrame, features: Sequence[str] = FEATURES, by: Sequence[str] = ()) -> DataFrame:
    """Per-feature mean and population std (0 -> 1.0), rounded 6; wide, one row per group.

    One aggregate pass with map-side partial aggregation; output size is the
    number of groups, never the number of rows.
    """
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        aggs.append(F.round(F.avg(x), 6).alias(f"mean_{f}"))
        sd = F.stddev_pop(x)
        aggs.append(F.round(F.when(sd == 0, F.lit(1.0)).otherwise(sd), 6).alias(f"std_{f}"))
    return df.groupBy(*by).agg(*aggs)


def stats_long(stats: DataFrame, features: Sequence[str] = FEATURES, by: Sequence[str] = ()) -> DataFrame:
    """Wide stats row -> (feature, mean, std) rows."""
    items = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"mean_{f}").alias("mean"),
                               F.col(f"std_{f}").alias("std")) for f in features])
    return stats.select(*by, F.inline(items))


def standardize(df: DataFrame, stats: DataFrame, features: Sequence[str] = FEATURES,
                keep: Sequence[str] = (), on: Sequence[str] = ()) -> DataFrame:
    """z = (x - mean) / max(std, 1e-9), with stats broadcast (one row per group)."""
    s = bounded_broadcast(stats, 10_000, "feature stats (one row per group)")
    j = df.join(s, list(on), "inner") if on else df.crossJoin(s)
    return j.select(*keep, *[((F.col(f) - F.col(f"mean_{f}")) / F.greatest(F.col(f"std_{f}"), F.lit(1e-9))).alias(f)
                             for f in features])


def registered_models(spark: SparkSession) -> DataFrame:
    cols = ["model", "version", "role", "bias", *[f"w_{f}" for f in FEATURES], "enterprise_adj", "threshold"]
    return spark.createDataFrame(REGISTERED_MODELS, cols)


def model_table(spark: SparkSession, train: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Registered weights + feature statistics of the train split = scorable models."""
    stats = bounded_broadcast(feature_stats(train, features), 1, "global feature stats")
    return registered_models(spark).crossJoin(stats)


def logit_expr(features: Sequence[str] = FEATURES, segment: str = "segment") -> Column:
    logit = F.col("bias")
    for f in features:
        z = (F.col(f).cast("double") - F.col(f"mean_{f}")) / F.greatest(F.col(f"std_{f}"), F.lit(1e-9))
        logit = logit + F.col(f"w_{f}") * z
    adj = F.coalesce(F.col("enterprise_adj"), F.lit(DEFAULT_ENTERPRISE_ADJ))
    return logit + F.when(F.col(segment) == "enterprise", adj).otherwise(F.lit(0.0))


def score(df: DataFrame, models: DataFrame, keep: Sequence[str] = (), features: Sequence[str] = FEATURES,
          model_filter: Column | None = None) -> DataFrame:
    """P4 + P5: churn_score (rounded 6) and prediction for every (row, model).

    ``models`` is a registry table (a handful of rows per model); it is
    broadcast after a size check, so the fact side is never shuffled.
    """
    m = models if model_filter is None else models.filter(model_filter)
    j = df.crossJoin(bounded_broadcast(m, 1_000, "registered model versions"))
    s = F.round(clipped_sigmoid(logit_expr(features)), 6)
    thr = F.coalesce(F.col("threshold"), F.lit(DEFAULT_THRESHOLD))
    return j.select(*keep, "model", "version", s.alias("churn_score"), thr.alias("threshold")) \
            .withColumn("prediction", (F.col("churn_score") >= F.col("threshold")).cast("int"))
