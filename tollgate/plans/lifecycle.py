"""Queries of the model lifecycle: features, scoring, evaluation, gates, quality, monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.guards import bounded_broadcast
from tollgate.operators import evaluate as ev
from tollgate.operators import model as mdl
from tollgate.operators import monitoring as mon
from tollgate.operators import quality as qa
from tollgate.plans.catalog import query
from tollgate.plans.sqlviews import rnd, with_views
from tollgate.sources import bindings as b

FEATS = mdl.FEATURES


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.churn_split(spark, sf)
    models = mdl.model_table(spark, rows.filter(F.col("split") == "train"))
    return mdl.score(rows, models, keep=["customer_id", "c_custkey", "segment", "churned", "split"])


# ---- P1 ---------------------------------------------------------------------
@query("feature_cast", with_views(
    "SELECT customer_id, " + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATS) + " FROM churn_base",
    "churn_base"))
def feature_cast(spark, sf):
    return mdl.cast_features(b.churn_base(spark, sf), keep=["customer_id"])


# ---- P2 ---------------------------------------------------------------------
def _std(x: str) -> str:
    return f"CASE WHEN stddev_pop({x}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({x}) END"


@query("feature_stats", with_views(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, {rnd(f'avg({f})', 6)} AS mean, {rnd(_std(f), 6)} AS std "
    f"FROM churn_split WHERE split = 'train'" for f in FEATS), "churn_split"))
def feature_stats(spark, sf):
    train = b.churn_split(spark, sf).filter(F.col("split") == "train")
    return mdl.stats_long(mdl.feature_stats(train))


# ---- P3 ---------------------------------------------------------------------
@query("feature_standardize", with_views(
    "SELECT s.customer_id, " + ", ".join(
        f"{rnd(f'(s.{f} - t.mean_{f}) / greatest(t.std_{f}, 1e-9::DOUBLE)', 6)} AS {f}" for f in FEATS)
    + " FROM churn_split s CROSS JOIN train_stats t", "churn_split", "train_stats"))
def feature_standardize(spark, sf):
    rows = b.churn_split(spark, sf)
    stats = mdl.feature_stats(rows.filter(F.col("split") == "train"))
    z = mdl.standardize(rows, stats, keep=["customer_id"])
    return z.select("customer_id", *[F.round(f, 6).alias(f) for f in FEATS])


# ---- P4 / P5 ----------------------------------------------------------------
@query("logit_score", with_views("SELECT customer_id, model, version, churn_score FROM scored", "scored"))
def logit_score(spark, sf):
    return _scored(spark, sf).select("customer_id", "model", "version", "churn_score")


@query("predict_label", with_views(
    "SELECT customer_id, version, threshold, prediction FROM scored", "scored"))
def predict_label(spark, sf):
    return _scored(spark, sf).select("customer_id", "version", "threshold", "prediction")


# ---- M4 ---------------------------------------------------------------------
_M4_SQL = f"""
SELECT model, version, split, tp, fp, tn, fn, rows,
       {rnd('(tp + tn) / greatest(tp + fp + tn + fn, 1)', 4)} AS accuracy,
       {rnd('prec', 4)} AS precision, {rnd('rec', 4)} AS recall,
       {rnd('2 * prec * rec / greatest(prec + rec, 1e-9::DOUBLE)', 4)} AS f1,
       {rnd('sq / greatest(rows, 1)', 4)} AS brier_score,
       {rnd('ssum / greatest(rows, 1)', 6)} AS mean_score
FROM (
  SELECT *, tp / greatest(tp + fp, 1) AS prec, tp / greatest(tp + fn, 1) AS rec FROM (
    SELECT model, version, split,
           count(*) FILTER (WHERE prediction = 1 AND churned = 1) AS tp,
           count(*) FILTER (WHERE prediction = 1 AND churned = 0) AS fp,
           count(*) FILTER (WHERE prediction = 0 AND churned = 0) AS tn,
           count(*) FILTER (WHERE prediction = 0 AND churned <> 0) AS fn,
           sum(pow(churn_score - churned, 2)) AS sq, sum(churn_score) AS ssum, count(*) AS rows
    FROM scored GROUP BY model, version, split))"""


@query("confusion_metrics", with_views(_M4_SQL, "scored"))
def confusion_metrics(spark, sf):
    return ev.confusion_metrics(_scored(spark, sf))


# ---- M5 ---------------------------------------------------------------------
_M5_SQL = f"""
SELECT s.*, g.segment_accuracy_gap FROM (
  SELECT model, version, split, segment,
         {rnd('avg(CAST(prediction = churned AS DOUBLE))', 4)} AS accuracy
  FROM scored GROUP BY ALL) s
JOIN (
  SELECT model, version, split, {rnd('max(accuracy) - min(accuracy)', 4)} AS segment_accuracy_gap FROM (
    SELECT model, version, split, segment,
           {rnd('avg(CAST(prediction = churned AS DOUBLE))', 4)} AS accuracy
    FROM scored GROUP BY ALL) GROUP BY ALL) g USING (model, version, split)"""


@query("segment_accuracy_gap", with_views(_M5_SQL, "scored"))
def segment_accuracy_gap(spark, sf):
    return ev.segment_accuracy(_scored(spark, sf))


# ---- M6 ---------------------------------------------------------------------
_M6_SQL = f"""
SELECT model, version, {rnd('threshold', 2)} AS threshold, f1, accuracy, segment_accuracy_gap,
       {rnd('objective', 6)} AS objective FROM (
  SELECT *, row_number() OVER (PARTITION BY model, version ORDER BY objective DESC, threshold) AS r FROM (
    SELECT *, f1 + 0.15::DOUBLE * accuracy - 0.05::DOUBLE * segment_accuracy_gap AS objective FROM (
      SELECT model, version, threshold,
             {rnd('(tp + tn) / greatest(tp + fp + tn + fn, 1)', 4)} AS accuracy,
             {rnd('2 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / greatest(tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1), 1e-9::DOUBLE)', 4)} AS f1,
             gap AS segment_accuracy_gap FROM (
        SELECT model, version, threshold, sum(tp) AS tp, sum(fp) AS fp, sum(tn) AS tn, sum(fn) AS fn,
               {rnd('max(acc) - min(acc)', 4)} AS gap FROM (
          SELECT model, version, threshold, segment, tp, fp, tn, fn,
                 {rnd('(tp + tn) / greatest(tp + fp + tn + fn, 1)', 4)} AS acc FROM (
            SELECT model, version, t.threshold, segment,
                   count(*) FILTER (WHERE churn_score >= t.threshold AND churned = 1) AS tp,
                   count(*) FILTER (WHERE churn_score >= t.threshold AND churned = 0) AS fp,
                   count(*) FILTER (WHERE churn_score < t.threshold AND churned = 0) AS tn,
                   count(*) FILTER (WHERE churn_score < t.threshold AND churned <> 0) AS fn
            FROM scored, (SELECT CAST(s AS DOUBLE) / 100 AS threshold FROM range(20, 61) r(s)) t
            WHERE split = 'validation'
            GROUP BY ALL))
        GROUP BY ALL))))
WHERE r = 1"""


@query("threshold_search", with_views(_M6_SQL, "scored"))
def threshold_search(spark, sf):
    val = _scored(spark, sf).filter(F.col("split") == "validation")
    return ev.threshold_search(val, spark)


# ---- M7 ---------------------------------------------------------------------
def _gate_values_sql() -> str:
    rows = ", ".join(f"('{g}', '{m}', '{d}', CAST({t!r} AS DOUBLE))" for g, m, d, t in ev.GATES)
    return f"(VALUES {rows}) p(gate, metric, direction, threshold)"


_DQ_SQL = """SELECT CASE WHEN count(*) >= 500
       AND count(*) FILTER (WHERE customer_id IS NULL OR segment IS NULL OR churned IS NULL) = 0
       AND count(*) FILTER (WHERE churned NOT IN (0, 1)) = 0
       AND avg(churned) BETWEEN 0.05 AND 0.8 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v FROM churn_base"""

_M7_SQL = f"""
WITH m AS (
  SELECT model, version, accuracy, f1, brier_score, gap FROM (
    SELECT model, version, split,
           {rnd('avg(CAST(prediction = churned AS DOUBLE))', 4)} AS accuracy,
           {rnd('2 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / greatest(tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1), 1e-9::DOUBLE)', 4)} AS f1,
           {rnd('avg(pow(churn_score - churned, 2))', 4)} AS brier_score
    FROM (SELECT *, count(*) FILTER (WHERE prediction = 1 AND churned = 1) OVER k AS tp,
                    count(*) FILTER (WHERE prediction = 1 AND churned = 0) OVER k AS fp,
                    count(*) FILTER (WHERE prediction = 0 AND churned <> 0) OVER k AS fn
          FROM scored WINDOW k AS (PARTITION BY model, version, split))
    WHERE split = 'test' GROUP BY model, version, split, tp, fp, fn) a
  JOIN (SELECT model, version, {rnd('max(acc) - min(acc)', 4)} AS gap FROM (
          SELECT model, version, segment, {rnd('avg(CAST(prediction = churned AS DOUBLE))', 4)} AS acc
          FROM scored WHERE split = 'test' GROUP BY ALL) GROUP BY ALL) g USING (model, version)),
lat AS (
  SELECT model_version AS version,
         {rnd('list_sort(list(latency_ms))[least(CAST(round_even((count(*) - 1) * 0.95, 0) AS BIGINT), count(*) - 1) + 1]', 4)} AS p95
  FROM prediction_log GROUP BY model_version),
dq AS ({_DQ_SQL}),
long AS (
  SELECT model, version, 'accuracy' AS metric, accuracy AS value FROM m
  UNION ALL SELECT model, version, 'f1', f1 FROM m
  UNION ALL SELECT model, version, 'brier_score', brier_score FROM m
  UNION ALL SELECT model, version, 'segment_accuracy_gap', gap FROM m
  UNION ALL SELECT model, version, 'data_quality_passed', dq.v FROM m, dq
  UNION ALL SELECT model, version, 'latency_p95_ms', lat.p95 FROM m JOIN lat USING (version))
SELECT e.model, e.version, p.gate, p.metric, l.value AS observed, p.threshold,
       coalesce(CASE WHEN p.direction = 'min' THEN l.value >= p.threshold ELSE l.value <= p.threshold END, false)
         AS passed
FROM {_gate_values_sql()} CROSS JOIN (SELECT DISTINCT model, version FROM m) e
LEFT JOIN long l ON l.model = e.model AND l.version = e.version AND l.metric = p.metric"""


def gate_table(spark: SparkSession, sf: str, scored: DataFrame | None = None) -> DataFrame:
    """M7 fan-in: test-split metrics + data-quality suite + serving p95 per version (of the registered models, or of ``scored``)."""
    scored = _scored(spark, sf) if scored is None else scored
    test = scored.filter(F.col("split") == "test")
    by = ["model", "version"]
    m = ev.metrics_from_segments(ev.segment_confusion(test, by=by), by=by)
    dq = (qa.validate_dataset(b.churn_base(spark, sf))
          .agg(F.bool_and("passed").cast("double").alias("data_quality_passed")))
    lat = (mon.latency_percentiles(b.prediction_log(spark, sf), by=["model_version"])
           .select(F.col("model_version").alias("version"), F.col("p95").alias("latency_p95_ms")))
    wide = (m.crossJoin(bounded_broadcast(dq, 1, "global quality verdict"))
             .join(bounded_broadcast(lat, 100_000, "p95 per model version"), "version", "left"))
    long = ev.metrics_to_long(wide, ["accuracy", "f1", "brier_score", "segment_accuracy_gap",
                                     "data_quality_passed", "latency_p95_ms"], by)
    return ev.evaluation_gates(long, ev.gate_policy(spark), by=by)


query("evaluation_gates", with_views(_M7_SQL, "scored", "churn_base", "prediction_log"))(gate_table)


# ---- Q1 ---------------------------------------------------------------------
_Q1_SQL = f"""
WITH a AS (
  SELECT count(*) AS n,
         sum((customer_id IS NULL OR customer_id = '')::INT + (segment IS NULL OR segment = '')::INT
             + (tenure_months IS NULL)::INT + (monthly_spend IS NULL)::INT + (support_tickets IS NULL)::INT
             + (late_payments IS NULL)::INT + (usage_drop_pct IS NULL)::INT + (churned IS NULL)::INT) AS nulls,
         sum((TRY_CAST(CAST(tenure_months AS VARCHAR) AS DOUBLE) IS NULL)::INT
             + (TRY_CAST(CAST(monthly_spend AS VARCHAR) AS DOUBLE) IS NULL)::INT
             + (TRY_CAST(CAST(support_tickets AS VARCHAR) AS DOUBLE) IS NULL)::INT
             + (TRY_CAST(CAST(late_payments AS VARCHAR) AS DOUBLE) IS NULL)::INT
             + (TRY_CAST(CAST(usage_drop_pct AS VARCHAR) AS DOUBLE) IS NULL)::INT) AS bad_num,
         count(*) FILTER (WHERE churned IS NULL OR CAST(churned AS VARCHAR) NOT IN ('0', '1')) AS bad_target,
         bool_or(churned = 0) AS has0, bool_or(churned = 1) AS has1,
         {rnd('coalesce(sum(churned), 0) / greatest(count(*), 1)', 4)} AS rate
  FROM churn_base)
SELECT 'row_count_min_500' AS "check", n >= 500 AS passed, CAST(n AS DOUBLE) AS observed_num,
       NULL::VARCHAR AS observed_txt, 500.0::DOUBLE AS threshold FROM a
UNION ALL SELECT 'required_columns_present', true, 0.0, '', NULL FROM a
UNION ALL SELECT 'no_nulls_in_required_columns', nulls = 0, CAST(nulls AS DOUBLE), NULL, NULL FROM a
UNION ALL SELECT 'numeric_features_parse', bad_num = 0, CAST(bad_num AS DOUBLE), NULL, NULL FROM a
UNION ALL SELECT 'binary_target', bad_target = 0, CAST(bad_target AS DOUBLE),
       concat_ws(',', CASE WHEN has0 THEN '0' END, CASE WHEN has1 THEN '1' END), NULL FROM a
UNION ALL SELECT 'target_has_signal', rate BETWEEN 0.05 AND 0.8, rate, NULL, NULL FROM a"""


@query("validate_dataset", with_views(_Q1_SQL, "churn_base"))
def validate_dataset(spark, sf):
    return qa.validate_dataset(b.churn_base(spark, sf))


# ---- Q2 ---------------------------------------------------------------------
def _q2_sql() -> str:
    parts = []
    for c, rule, arg in qa.CONTRACT_RULES:
        a = "NULL::VARCHAR" if arg is None else f"'{arg}'"
        if rule == "unique":
            parts.append(f"SELECT '{c}' AS \"column\", '{rule}' AS rule, {a} AS arg, "
                         f"CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS violations "
                         f"FROM (SELECT count(*) AS k FROM churn_base GROUP BY {c} HAVING count(*) > 1)")
            continue
        if rule == "required":
            bad = f"{c} IS NULL OR CAST({c} AS VARCHAR) = ''"
        elif rule == "min":
            bad = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) < {float(arg)}"
        elif rule == "max":
            bad = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) > {float(arg)}"
        else:
            vals = ", ".join(f"'{v}'" for v in arg.split(","))
            bad = f"CAST({c} AS VARCHAR) NOT IN ({vals})"
        parts.append(f"SELECT '{c}' AS \"column\", '{rule}' AS rule, {a} AS arg, "
                     f"count(*) FILTER (WHERE coalesce({bad}, false)) AS violations FROM churn_base")
    return "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


@query("contract_check", with_views(_q2_sql(), "churn_base"))
def contract_check(spark, sf):
    return qa.contract_check(b.churn_base(spark, sf))


# ---- Q3 ---------------------------------------------------------------------
SERVING_FEATURES = ("segment", *FEATS)


@query("serving_feature_check", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = '') AS missing, "
    f"count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = '') = 0 AS passed FROM churn_current"
    for c in SERVING_FEATURES), "churn_current"))
def serving_feature_check(spark, sf):
    return qa.serving_feature_check(b.churn_current(spark, sf), SERVING_FEATURES)


# ---- D1..D8 -----------------------------------------------------------------
def _nr(expr_list: str, p: float) -> str:
    return (f"{rnd(f'list_sort(list({expr_list}))[least(CAST(round_even((count(*) - 1) * {p}, 0) AS BIGINT), '
                   f'count(*) - 1) + 1]', 4)}")


@query("latency_percentiles", with_views(
    f"SELECT service, {_nr('latency_ms', 0.5)} AS p50, {_nr('latency_ms', 0.95)} AS p95, "
    f"{_nr('latency_ms', 0.99)} AS p99, count(*) AS samples FROM prediction_log GROUP BY service",
    "prediction_log"))
def latency_percentiles(spark, sf):
    return mon.latency_percentiles(b.prediction_log(spark, sf))


def _means_sql(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {rnd(f'coalesce(avg({f}), 0.0)', 4)} AS mean FROM {src}" for f in FEATS)


@query("feature_means", with_views(
    "SELECT split, feature, mean FROM (" + " UNION ALL ".join(
        f"SELECT split, '{f}' AS feature, {rnd(f'coalesce(avg({f}), 0.0)', 4)} AS mean FROM churn_split GROUP BY split"
        for f in FEATS) + ")", "churn_split"))
def feature_means(spark, sf):
    return mon.feature_means(b.churn_split(spark, sf), by=["split"])


_D3_SQL = f"""
WITH r AS ({_means_sql("(SELECT * FROM churn_split WHERE split = 'train')")}),
     c AS ({_means_sql("churn_current")}),
     n AS (SELECT count(*) AS n FROM churn_current),
     d AS (SELECT r.feature, r.mean AS reference_mean,
                  CASE WHEN n.n > 0 THEN c.mean ELSE r.mean END AS current_mean,
                  CASE WHEN r.feature = 'monthly_spend' THEN 20.0::DOUBLE ELSE 0.25::DOUBLE END AS "limit"
           FROM r JOIN c USING (feature), n)
SELECT feature, reference_mean, current_mean, {rnd('current_mean - reference_mean', 4)} AS delta, "limit",
       abs({rnd('current_mean - reference_mean', 4)}) > "limit" AS flagged FROM d"""


def _drift(spark, sf):
    train = b.churn_split(spark, sf).filter(F.col("split") == "train")
    return mon.feature_drift(train, b.churn_current(spark, sf), mon.drift_limits(spark))


@query("feature_drift", with_views(_D3_SQL, "churn_split", "churn_current"))
def feature_drift(spark, sf):
    return _drift(spark, sf)


@query("drift_alert_list", with_views(
    f"SELECT coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE flagged)), ','), '') AS alerts, "
    f"NOT bool_or(flagged) AS passed "
    f"FROM ({_D3_SQL})", "churn_split", "churn_current"))
def drift_alert_list(spark, sf):
    return mon.drift_alert_list(_drift(spark, sf))


@query("prediction_drift", with_views(
    f"SELECT model_version, {rnd('avg(churn_score)', 6)} AS mean_score, "
    f"{rnd('avg(CAST(churn_score >= 0.5 AS DOUBLE))', 4)} AS high_risk_share, count(*) AS predictions "
    f"FROM prediction_log GROUP BY model_version", "prediction_log"))
def prediction_drift(spark, sf):
    return mon.prediction_drift(b.prediction_log(spark, sf))


@query("recent_predictions", with_views(
    "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY service ORDER BY ts DESC, request_id DESC) "
    "AS INTEGER) AS recency_rank FROM prediction_log) WHERE recency_rank <= 20", "prediction_log"))
def recent_predictions(spark, sf):
    return mon.recent_predictions(b.prediction_log(spark, sf))


@query("active_version", with_views(
    "SELECT service, coalesce(arg_max(model_version, (ts, request_id)), 'unknown') AS active_version "
    "FROM prediction_log GROUP BY service", "prediction_log"))
def active_version(spark, sf):
    return mon.active_version(b.prediction_log(spark, sf))


@query("throughput_error_rate", with_views(
    f"SELECT service, count(*) AS prediction_count, "
    f"{rnd('avg(CAST(status <> \'success\' AS DOUBLE))', 6)} AS error_rate FROM prediction_log GROUP BY service",
    "prediction_log"))
def throughput_error_rate(spark, sf):
    return mon.throughput_error_rate(b.prediction_log(spark, sf))
