"""Model training on Spark: regularised logistic regression (Spark ML), gradient check,
per-segment fits, batch scoring with idempotent partition overwrite, shadow comparison."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.exprs import clipped_sigmoid
from tollgate.functions.guards import bounded_broadcast
from tollgate.operators.model import FEATURES, feature_stats, standardize
from tollgate.session import ensure_checkpoint_dir

# The Newton steps (M3) run in Python workers: shipped by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

L2 = 5e-4


def design_matrix(rows: DataFrame, stats: DataFrame, features: Sequence[str] = FEATURES,
                  label: str = "churned", segment: str = "segment", with_segment: bool = True) -> DataFrame:
    """z-scored features (+ enterprise indicator) and the label, assembled into a vector."""
    z = standardize(rows, stats, features, keep=[label, segment])
    cols = list(features)
    if with_segment:
        z = z.withColumn("enterprise", (F.col(segment) == "enterprise").cast("double"))
        cols.append("enterprise")
    return VectorAssembler(inputCols=cols, outputCol="x").transform(z).select("x", F.col(label).cast("double").alias("y"))


def train_logistic(train: DataFrame, features: Sequence[str] = FEATURES, with_segment: bool = True,
                   max_iter: int = 200) -> DataFrame:
    """M1: same convex objective as full-batch descent -- mean log-loss + L2/2 * ||w||^2, intercept
    unpenalised -- solved by L-BFGS with per-iteration ``treeAggregate`` on the executors.
    Returns (term, coefficient) rows."""
    spark = train.sparkSession
    stats = feature_stats(train, features)
    xy = design_matrix(train, stats, features, with_segment=with_segment)
    lr = LogisticRegression(featuresCol="x", labelCol="y", regParam=L2, elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=1e-10)
    m = lr.fit(xy)
    terms = [*features, *(["enterprise"] if with_segment else [])]
    rows = [(t, float(c)) for t, c in zip(terms, m.coefficients.toArray())] + [("intercept", float(m.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double") \
        .withColumn("iterations", F.lit(m.summary.totalIterations))


def model_row(fit: DataFrame, train: DataFrame, model: str, version: str, features: Sequence[str] = FEATURES, digits: int = 3) -> DataFrame:
    """A fit's (term, coefficient) rows as one scorable row of a model table, with the feature statistics it was fitted on
    and no threshold yet."""
    weight = lambda term: F.round(F.max(F.when(F.col("term") == term, F.col("coefficient"))), digits)
    row = fit.agg(weight("intercept").alias("bias"), *[weight(f).alias(f"w_{f}") for f in features], weight("enterprise").alias("enterprise_adj"))
    return (row.crossJoin(bounded_broadcast(feature_stats(train, features), 1, "global feature stats"))
               .select(F.lit(model).alias("model"), F.lit(version).alias("version"), "*", F.lit(None).cast("double").alias("threshold")))


def gradient(train: DataFrame, models: DataFrame, features: Sequence[str] = FEATURES,
             label: str = "churned", segment: str = "segment", l2: float = L2) -> DataFrame:
    """M2: one full-batch gradient of the regularised objective at each model's weights.

    One aggregate over the train rows (map-side partial sums):
    d/db = mean(err); d/dw_i = mean(err * z_i) + l2 * w_i; d/dw_ent likewise.
    """
    j = train.crossJoin(bounded_broadcast(models, 1_000, "registered model versions"))
    logit = F.col("bias")
    zs = {}
    for f in features:
        zs[f] = (F.col(f).cast("double") - F.col(f"mean_{f}")) / F.greatest(F.col(f"std_{f}"), F.lit(1e-9))
        logit = logit + F.col(f"w_{f}") * zs[f]
    ent = (F.col(segment) == "enterprise").cast("double")
    logit = logit + F.col("enterprise_adj") * ent
    err = clipped_sigmoid(logit) - F.col(label)
    g = j.groupBy("model", "version").agg(
        F.avg(err).alias("g_intercept"),
        *[(F.avg(err * zs[f]) + l2 * F.first(f"w_{f}")).alias(f"g_{f}") for f in features],
        (F.avg(err * ent) + l2 * F.first("enterprise_adj")).alias("g_enterprise"))
    terms = ["intercept", *features, "enterprise"]
    items = F.array(*[F.struct(F.lit(t).alias("term"), F.round(F.col(f"g_{t}"), 6).alias("gradient")) for t in terms])
    return g.select("model", "version", F.inline(items))


def _newton_step(k: int, l2: float):
    """Normal equations of each segment (one row) -> its next weights and the gradient at the present ones."""
    upper = np.triu_indices(k)
    penalty = np.full(k, l2)
    penalty[0] = 0.0                                          # the intercept is free

    def run(batches):
        for d in batches:
            out = []
            for r in d.itertuples(index=False):
                w, n = np.array(r.w, dtype=float), float(r.n)
                h = np.zeros((k, k))
                h[upper] = np.array(r.h, dtype=float) / n
                h = h + np.triu(h, 1).T + np.diag(penalty)
                g = np.array(r.g, dtype=float) / n + penalty * w
                step = np.linalg.lstsq(h, g, rcond=None)[0]
                step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
                out.append((r.segment, w - step, g, float(np.abs(step).max())))
            yield pd.DataFrame(out, columns=["segment", "w", "g", "step"])
    return run


def train_by_segment(train: DataFrame, segment: str = "segment", features: Sequence[str] = FEATURES, label: str = "churned",
                     l2: float = L2, max_iter: int = 30, tol: float = 1e-9) -> DataFrame:
    """M3: one model per segment (the objective of M1, z-scores of the segment), all fitted together by Newton's method.

    An iteration is one aggregate over the rows: per segment the sums of gradient and Hessian, combined before the shuffle, so
    a hot segment is as many tasks as it has rows for, and there may be any number of segments.  The small systems of the segments are
    solved where their sums are.  One number an iteration reaches the driver, the largest step of any segment.
    Returns (segment, term, coefficient, gradient, iterations, converged)."""
    terms = ["intercept", *features]
    k = len(terms)
    z = [(F.col(f).cast("double") - F.col(f"mean_{f}")) / F.greatest(F.col(f"std_{f}"), F.lit(1e-9)) for f in features]
    x = (train.join(feature_stats(train, features, by=[segment]), segment)
              .select(F.col(segment).alias("segment"), F.col(label).cast("double").alias("y"), *[c.alias(f"x{i}") for i, c in enumerate([F.lit(1.0), *z])]))
    xs = [F.col(f"x{i}") for i in range(k)]
    x = x.checkpoint() if ensure_checkpoint_dir(train.sparkSession) else x
    kind = x.schema["segment"].dataType.simpleString()
    w = x.groupBy("segment").agg(F.count(F.lit(1)).alias("_n")).select("segment", F.array_repeat(F.lit(0.0), k).alias("w"))
    done = 0
    while True:
        logit = sum((F.get("w", F.lit(i)) * c for i, c in enumerate(xs)), F.lit(0.0))
        p = x.join(w.select("segment", "w"), "segment").withColumn("p", clipped_sigmoid(logit))
        v = F.col("p") * (1 - F.col("p"))
        sums = p.groupBy("segment").agg(
            F.count(F.lit(1)).alias("n"), F.first("w").alias("w"), *[F.sum((F.col("p") - F.col("y")) * c).alias(f"g{i}") for i, c in enumerate(xs)],
            *[F.sum(v * xs[i] * xs[j]).alias(f"h{i}_{j}") for i in range(k) for j in range(i, k)])
        row = sums.select("segment", "n", "w", F.array(*[F.col(f"g{i}") for i in range(k)]).alias("g"),
                          F.array(*[F.col(f"h{i}_{j}") for i in range(k) for j in range(i, k)]).alias("h"))
        w = row.mapInPandas(_newton_step(k, l2), f"segment {kind}, w array<double>, g array<double>, step double").checkpoint()
        done += 1
        if (w.agg(F.max("step")).first()[0] or 0.0) <= tol or done >= max_iter:
            break
    each = F.arrays_zip(F.array(*[F.lit(t) for t in terms]).alias("term"), F.col("w"), F.col("g"))
    return (w.select("segment", (F.col("step") <= tol).alias("converged"), F.explode(each).alias("e"))
             .select(F.col("segment").alias(segment), "e.term", F.col("e.w").alias("coefficient"), F.col("e.g").alias("gradient"), F.lit(done).alias("iterations"), "converged"))


def batch_score(scored: DataFrame, path: str, partition: str = "split") -> DataFrame:
    """M8: write scores partitioned by ``partition`` with dynamic partition overwrite.

    Re-running for the same partitions replaces exactly those partitions
    (idempotent per partition); other partitions are left alone.
    """
    (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition).parquet(path))
    return scored.sparkSession.read.parquet(path)


def shadow_compare(rows: DataFrame, champion: DataFrame, challenger: DataFrame, segment: str = "segment",
                   features: Sequence[str] = FEATURES) -> DataFrame:
    """M9: champion and challenger scored in one projection (two one-row broadcasts), compared per segment."""
    a = champion.select(*[F.col(c).alias(f"{c}__a") for c in champion.columns])
    b = challenger.select(*[F.col(c).alias(f"{c}__b") for c in challenger.columns])
    j = rows.crossJoin(bounded_broadcast(a, 1, "champion")).crossJoin(bounded_broadcast(b, 1, "challenger"))

    def score_for(sfx: str):
        m = {c: F.col(f"{c}__{sfx}") for c in champion.columns}
        logit = m["bias"]
        for f in features:
            z = (F.col(f).cast("double") - m[f"mean_{f}"]) / F.greatest(m[f"std_{f}"], F.lit(1e-9))
            logit = logit + m[f"w_{f}"] * z
        logit = logit + F.when(F.col(segment) == "enterprise", F.coalesce(m["enterprise_adj"], F.lit(-0.25))) \
            .otherwise(F.lit(0.0))
        s = F.round(clipped_sigmoid(logit), 6)
        return s, (s >= F.coalesce(m["threshold"], F.lit(0.5))).cast("int")

    sa, pa = score_for("a")
    sb, pb = score_for("b")
    d = j.select(segment, sa.alias("sa"), pa.alias("pa"), sb.alias("sb"), pb.alias("pb"))
    return d.groupBy(segment).agg(F.count(F.lit(1)).alias("rows"),
                                  F.count_if(F.col("pa") != F.col("pb")).alias("label_flips"),
                                  F.round(F.avg(F.col("sb") - F.col("sa")), 6).alias("mean_score_delta"))


def models_by_role(models: DataFrame, role: str) -> DataFrame:
    return models.filter(F.col("role") == role)
