"""Data quality: dataset validation, contract rules, serving features, roll-ups.

Every check is one aggregate expression; all checks of a dataset run in a
single scan, and the one-row result is unpivoted into a check table
(check, passed, observed_num, observed_txt, threshold).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.exprs import is_blank

FEATURES = ("tenure_months", "monthly_spend", "support_tickets", "late_payments", "usage_drop_pct")
REQUIRED_COLUMNS = ("customer_id", "segment", *FEATURES, "churned")

# Training-data suite limits.
MIN_ROWS = 500
POSITIVE_RATE_RANGE = (0.05, 0.8)


def _check(name: str, passed: Column, num: Column | None = None, txt: Column | None = None,
           threshold: float | None = None) -> Column:
    return F.struct(F.lit(name).alias("check"), passed.alias("passed"),
                    (num if num is not None else F.lit(None)).cast("double").alias("observed_num"),
                    (txt if txt is not None else F.lit(None)).cast("string").alias("observed_txt"),
                    F.lit(threshold).cast("double").alias("threshold"))


def validate_dataset(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS,
                     features: Sequence[str] = FEATURES, target: str = "churned",
                     by: Sequence[str] = ()) -> DataFrame:
    """Q1: six checks in one pass over ``df`` (works on typed or all-string input)."""
    present = [c for c in required if c in df.columns]
    missing = sorted(set(required) - set(df.columns))
    nulls = sum((is_blank(c).cast("long") for c in present), F.lit(0))
    bad_num = sum(((F.col(f).cast("string").try_cast("double").isNull()).cast("long")
                   for f in features if f in df.columns), F.lit(0))
    bad_num = bad_num + F.lit(len([f for f in features if f not in df.columns]))
    t = F.col(target).cast("string") if target in df.columns else F.lit(None).cast("string")
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(nulls).alias("nulls"),
        F.sum(bad_num).alias("bad_num"),
        F.count_if(~t.isin("0", "1") | t.isNull()).alias("bad_target"),
        F.bool_or(t == "0").alias("has0"),
        F.bool_or(t == "1").alias("has1"),
        F.sum(t.try_cast("int")).alias("pos"),
    )
    rate = F.round(F.coalesce(F.col("pos"), F.lit(0)) / F.greatest(F.col("n"), F.lit(1)), 4)
    seen = F.concat_ws(",", F.array_compact(F.array(F.when(F.col("has0"), "0"), F.when(F.col("has1"), "1"))))
    lo, hi = POSITIVE_RATE_RANGE
    checks = F.array(
        _check("row_count_min_500", F.col("n") >= MIN_ROWS, F.col("n"), threshold=MIN_ROWS),
        _check("required_columns_present", F.lit(not missing), F.lit(len(missing)), F.lit(",".join(missing))),
        _check("no_nulls_in_required_columns", F.coalesce(F.col("nulls"), F.lit(0)) == 0,
               F.coalesce(F.col("nulls"), F.lit(0))),
        _check("numeric_features_parse", F.coalesce(F.col("bad_num"), F.lit(0)) == 0,
               F.coalesce(F.col("bad_num"), F.lit(0))),
        _check("binary_target", F.col("bad_target") == 0, F.col("bad_target"), seen),
        _check("target_has_signal", (rate >= lo) & (rate <= hi), rate),
    )
    return agg.select(*by, F.inline(checks))


# The training data contract (column, rule, argument).
CONTRACT_RULES = [
    ("customer_id", "required", None), ("customer_id", "unique", None),
    ("segment", "required", None), ("segment", "allowed_values", "enterprise,self_serve"),
    ("tenure_months", "required", None), ("tenure_months", "min", "1"),
    ("monthly_spend", "required", None), ("monthly_spend", "min", "0"),
    ("support_tickets", "required", None), ("support_tickets", "min", "0"),
    ("late_payments", "required", None), ("late_payments", "min", "0"),
    ("usage_drop_pct", "required", None), ("usage_drop_pct", "min", "0"), ("usage_drop_pct", "max", "1"),
    ("churned", "required", None), ("churned", "allowed_values", "0,1"),
]


def contract_check(df: DataFrame, rules=CONTRACT_RULES, key_unique_via_groupby: bool = True) -> DataFrame:
    """Q2: violation count per (column, rule) in one scan; ``unique`` via groupBy(key).

    Rules are data; each becomes one conditional count in a single aggregate.
    Uniqueness needs a shuffle on the key (groupBy(key).count() > 1).
    """
    exprs, names, uniques = [], [], []
    for i, (c, rule, arg) in enumerate(rules):
        x = F.col(c)
        if rule == "required":
            bad = is_blank(c)
        elif rule == "min":
            bad = x.cast("string").try_cast("double") < float(arg)
        elif rule == "max":
            bad = x.cast("string").try_cast("double") > float(arg)
        elif rule == "allowed_values":
            bad = ~x.cast("string").isin(*arg.split(","))
        elif rule == "unique":
            uniques.append((i, c, rule, arg))
            continue
        else:
            raise ValueError(rule)
        exprs.append(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r{i}"))
        names.append((i, c, rule, arg))
    one = df.agg(*exprs)
    items = [F.struct(F.lit(c).alias("column"), F.lit(rule).alias("rule"), F.lit(arg).cast("string").alias("arg"),
                      F.col(f"r{i}").alias("violations")) for i, c, rule, arg in names]
    out = one.select(F.inline(F.array(*items)))
    for i, c, rule, arg in uniques:
        dup = (df.groupBy(c).agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
                 .agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("violations")))
        out = out.unionByName(dup.select(F.lit(c).alias("column"), F.lit(rule).alias("rule"),
                                         F.lit(arg).cast("string").alias("arg"), "violations"))
    return out.withColumn("passed", F.col("violations") == 0)


def serving_feature_check(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Q3: rows missing any of the required online features (null-count per feature)."""
    items = [F.struct(F.lit(c).alias("feature"), F.count_if(is_blank(c)).alias("missing")) for c in required]
    return df.agg(F.array(*items).alias("a")).select(F.inline("a")).withColumn("passed", F.col("missing") == 0)


def check_rollup(checks: DataFrame, by: Sequence[str], name: str = "check", passed: str = "passed") -> DataFrame:
    """Q6: all checks pass -> passed; sorted failed names; Q7 score percentage."""
    return checks.groupBy(*by).agg(
        F.bool_and(passed).alias("passed"),
        F.array_sort(F.collect_list(F.when(~F.col(passed), F.col(name)))).alias("failed"),
        F.count(F.lit(1)).alias("checks"),
        F.round(100.0 * F.avg(F.col(passed).cast("double")), 2).alias("score_pct"),
    )


def quality_suites(df: DataFrame, partition: str, ts: str, value: str, label: str,
                   now: Column, ref_mean: Column, ref_std: Column, max_age_days: float = 2.0,
                   max_z_shift: float = 3.0, share_range=(0.05, 0.8)) -> DataFrame:
    """Q4: schema / freshness / distribution / label-balance checks per partition.

    ``ref_mean`` / ``ref_std`` are per-row columns holding the reference
    statistics (e.g. from a broadcast one-row aggregate).
    """
    g = df.groupBy(partition).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(value).isNull() | F.col(label).isNull()).alias("null_cells"),
        F.max(ts).alias("max_ts"),
        F.avg(value).alias("mean_value"),
        F.avg(F.col(label).cast("double")).alias("label_share"),
        F.max(ref_mean).alias("_ref_mean"), F.max(ref_std).alias("_ref_std"),
    )
    ref_mean, ref_std = F.col("_ref_mean"), F.col("_ref_std")
    age_days = (F.unix_timestamp(now) - F.unix_timestamp(F.col("max_ts"))) / 86400.0
    z = F.abs(F.col("mean_value") - ref_mean) / F.greatest(ref_std, F.lit(1e-9))
    lo, hi = share_range
    return g.select(
        partition, "rows",
        (F.col("null_cells") == 0).alias("schema_ok"),
        F.round(age_days, 4).alias("age_days"), (age_days <= max_age_days).alias("freshness_ok"),
        F.round(z, 4).alias("z_shift"), (z <= max_z_shift).alias("distribution_ok"),
        F.round("label_share", 4).alias("label_share"),
        F.col("label_share").between(lo, hi).alias("label_balance_ok"),
    )


def reconcile_counts(source: DataFrame, target: DataFrame, partition: str) -> DataFrame:
    """Q5: per-partition row counts of source vs materialised table (full outer join)."""
    a = source.groupBy(partition).agg(F.count(F.lit(1)).alias("source_rows"))
    b = target.groupBy(partition).agg(F.count(F.lit(1)).alias("target_rows"))
    j = a.join(b, partition, "full_outer")
    s, t = F.coalesce(F.col("source_rows"), F.lit(0)), F.coalesce(F.col("target_rows"), F.lit(0))
    return j.select(partition, s.alias("source_rows"), t.alias("target_rows"), (s - t).alias("diff"),
                    (s == t).alias("matched"))
