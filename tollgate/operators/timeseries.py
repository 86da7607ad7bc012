"""Time-series algebra over sample tables (labels..., ts, value).

Alert and dashboard expressions (counter rate, histogram quantile, vector
matching, absence, hold duration) as DataFrame functions.  Rules are data,
not parsed text.

Skew: no window is ever partitioned by a series alone over raw samples.
Counter deltas are taken on range-partitioned, sorted samples (a hot series
spans many tasks; one shuffle), trailing range aggregates use overlapping time
buckets, and hold-duration islands run on a pre-aggregated step table.

Semantics chosen: ``increase`` = sum of positive deltas between consecutive
samples inside the window (a drop is a counter reset: the new value counts),
``rate`` = increase / window seconds; no boundary extrapolation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.functions.guards import bounded_broadcast
from tollgate.functions.ranking import run_increase, run_summary


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# ---- T1 ---------------------------------------------------------------------
def label_match(df: DataFrame, matchers: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``=``, ``!=``, ``=~`` (fully anchored regex), ``!~`` label matchers, ANDed."""
    cond = F.lit(True)
    for label, op, val in matchers:
        c = F.coalesce(F.col(label).cast("string"), F.lit(""))
        if op == "=":
            cond = cond & (c == val)
        elif op == "!=":
            cond = cond & (c != val)
        elif op == "=~":
            cond = cond & c.rlike(f"^(?:{val})$")
        elif op == "!~":
            cond = cond & ~c.rlike(f"^(?:{val})$")
        else:
            raise ValueError(op)
    return df.filter(cond)


# ---- T2 / T3 / T4 -----------------------------------------------------------
def bucket_start(ts: str, seconds: int) -> Column:
    """Tumbling bucket start (epoch-aligned)."""
    sec = F.unix_timestamp(F.col(ts).cast("timestamp"))
    return F.timestamp_seconds(sec - F.pmod(sec, F.lit(seconds))).cast("timestamp_ntz")


def counter_increase(df: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
                     window_seconds: int = 300, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Increase of a counter per (series, tumbling window) with reset handling.

    Consecutive-sample deltas are taken on range-partitioned, sorted rows
    (``run_increase``): a (series, window) holding a third of all samples is
    still split across tasks, and the rows are shuffled once.
    """
    b = df.withColumn("window_start", bucket_start(ts, window_seconds))
    return run_increase(b, [*series, "window_start"], [ts, *tiebreak], value)


def counter_rate(df: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
                 window_seconds: int = 300, tiebreak: Sequence[str] = ()) -> DataFrame:
    inc = counter_increase(df, series, ts, value, window_seconds, tiebreak)
    return inc.withColumn("rate", F.col("increase") / F.lit(float(window_seconds)))


def sliding_increase(df: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value", window_seconds: int = 3600,
                     slide_seconds: int = 300, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Increase of a counter over overlapping windows, one every ``slide_seconds``, with resets counted.

    Samples are reduced to slots of the slide first: the increase inside of the slot, its first and last value (one
    shuffle of the samples).  The step from one slot to the next is the reset-aware difference of their edge values.
    A window is the sum over its slots, without the step into its first one, whose earlier sample lies outside."""
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    slots = run_summary(df.withColumn("slot", bucket_start(ts, slide_seconds)), [*series, "slot"], [ts, *tiebreak], value)
    before = F.lag("last_value").over(Window.partitionBy(*series).orderBy("slot"))
    into = (F.when(before.isNull(), F.lit(0.0)).when(F.col("first_value") >= before, F.col("first_value") - before).otherwise(F.col("first_value")))
    stepped = slots.withColumn("into", into)
    starts = F.transform(F.sequence(F.lit(0), F.lit(window_seconds // slide_seconds - 1)), lambda k: F.unix_timestamp(F.col("slot").cast("timestamp")) - k * slide_seconds)
    g = stepped.withColumn("_start", F.explode(starts)).groupBy(*series, "_start").agg(
        (F.sum("increase") + F.sum("into") - F.min_by("into", "slot")).alias("increase"), F.sum("samples").alias("samples"))
    return g.select(*series, F.timestamp_seconds("_start").cast("timestamp_ntz").alias("window_start"), "increase", "samples")


def sliding_rate(df: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value", window_seconds: int = 3600,
                 slide_seconds: int = 300, tiebreak: Sequence[str] = ()) -> DataFrame:
    """T3 over overlapping windows."""
    return sliding_increase(df, series, ts, value, window_seconds, slide_seconds, tiebreak).withColumn("rate", F.col("increase") / F.lit(float(window_seconds)))


def rate_ratio(num: DataFrame, den: DataFrame, on: Sequence[str]) -> DataFrame:
    """sum(rate(num)) / sum(rate(den)) by ``on`` (null when the denominator is 0)."""
    a = num.groupBy(*on).agg(F.sum("rate").alias("num_rate"))
    d = den.groupBy(*on).agg(F.sum("rate").alias("den_rate"))
    j = a.join(d, list(on), "inner")
    return j.withColumn("ratio", F.col("num_rate") / F.nullif(F.col("den_rate"), F.lit(0.0)))


# ---- T5 ---------------------------------------------------------------------
def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str], le: str = "le",
                       count: str = "bucket_count") -> DataFrame:
    """Quantile from cumulative ``le`` buckets, linear inside the bucket.

    The first bucket's lower bound is 0; a rank in the +Inf bucket returns the
    last finite bound.  Windows run per histogram (a handful of buckets).
    """
    s = buckets.groupBy(*by, le).agg(F.sum(count).alias("_cum"))
    w = Window.partitionBy(*by).orderBy(le)
    s = (s.withColumn("_prev_le", F.lag(le).over(w))
          .withColumn("_prev_cum", F.coalesce(F.lag("_cum").over(w), F.lit(0)))
          .withColumn("_total", F.max("_cum").over(Window.partitionBy(*by)))
          .withColumn("_last_finite", F.max(F.when(~F.isnan(le) & (F.col(le) != float("inf")), F.col(le)))
                      .over(Window.partitionBy(*by))))
    rank = F.lit(q) * F.col("_total")
    hit = s.filter(F.col("_cum") >= rank).withColumn(
        "_r", F.row_number().over(Window.partitionBy(*by).orderBy(le))).filter("_r = 1")
    lower = F.coalesce(F.col("_prev_le"), F.lit(0.0))
    inside = lower + (F.col(le) - lower) * (rank - F.col("_prev_cum")) / F.nullif(F.col("_cum") - F.col("_prev_cum"), F.lit(0))
    val = (F.when(F.col("_total") == 0, F.lit(None))
            .when(F.col(le) == float("inf"), F.col("_last_finite"))
            .otherwise(F.coalesce(inside, F.col(le))))
    return hit.select(*by, F.round(val, 4).alias("quantile_value"))


# ---- T6 / T7 ----------------------------------------------------------------
def latest_per_series(df: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Instant vector: the last sample of every series (max_by, partial aggregation)."""
    return df.groupBy(*series).agg(F.max_by(value, ts).alias(value), F.max(ts).alias(ts))


def agg_by(df: DataFrame, series: Sequence[str], by: Sequence[str], how: str = "sum",
           ts: str = "ts", value: str = "value") -> DataFrame:
    """``sum/max/min/avg/count by (labels)`` over the latest sample per series."""
    inst = latest_per_series(df, series, ts, value)
    fn = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}[how]
    return inst.groupBy(*by).agg(fn(value).alias(value))


def trailing_agg(df: DataFrame, series: Sequence[str], ts: str, value: str, window_seconds: int,
                 how: str = "max", bucket_seconds: int | None = None) -> DataFrame:
    """``<how>_over_time(v[w])`` for every sample: aggregate over [t - w, t].

    Skew-safe range frame: each sample is copied into its own bucket and the
    next (bucket >= w), windows run per (series, bucket), and only the copy in
    the sample's own bucket is kept.  A hot series is split by time.
    """
    bs = max(bucket_seconds or 0, window_seconds)
    sec = F.unix_timestamp(F.col(ts).cast("timestamp"))
    own = F.floor(sec / F.lit(bs))
    d = (df.withColumn("_sec", sec).withColumn("_own", own)
           .withColumn("_bucket", F.explode(F.array(F.col("_own"), F.col("_own") + 1))))
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "count": F.count}[how]
    w = Window.partitionBy(*series, "_bucket").orderBy("_sec").rangeBetween(-window_seconds, 0)
    out = d.withColumn(f"{how}_over_time", fn(value).over(w)).filter(F.col("_bucket") == F.col("_own"))
    return out.drop("_sec", "_own", "_bucket")


# ---- T8..T12 vector matching -----------------------------------------------
def vec_and(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left and on(labels) right``: keep left series that also exist on the right."""
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def vec_or(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left or right``: all of left plus right series absent from left."""
    return left.unionByName(right.join(left.select(*on), list(on), "left_anti"), allowMissingColumns=True)


def vec_unless(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left unless on(labels) right``."""
    return left.join(right.select(*on), list(on), "left_anti")


def vec_group_left(many: DataFrame, one: DataFrame, on: Sequence[str], op: str = "*",
                   value: str = "value", one_value: str = "value", out: str = "value") -> DataFrame:
    """``many <op> on(labels) group_left one``: many-to-one match.

    The ``one`` side must be unique per ``on``: a label set that a left row meets
    twice stops the job, as it does in PromQL.  Catalyst / AQE choose broadcast
    when the one side is small.
    """
    o = one.groupBy(*on).agg(F.max(one_value).alias("_one"), F.count(F.lit(1)).alias("_n"))
    several = F.raise_error(F.concat(F.lit("many-to-many match: the one side repeats "), F.concat_ws(", ", *[F.col(c).cast("string") for c in on])))
    o = o.select(*on, F.when(F.col("_n") == 1, F.col("_one")).otherwise(several).alias("_one"))
    j = many.join(o, list(on), "inner")
    expr = {"*": F.col(value) * F.col("_one"), "+": F.col(value) + F.col("_one"),
            "-": F.col(value) - F.col("_one"), "/": F.col(value) / F.nullif(F.col("_one"), F.lit(0.0))}[op]
    return j.withColumn(out, expr).drop("_one")


_OPS = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
        "<=": lambda a, b: a <= b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b}


def vec_compare(left: DataFrame, right: DataFrame | float, on: Sequence[str], op: str,
                value: str = "value", right_value: str = "value") -> DataFrame:
    """Filter ``left op right`` (series-series on labels, or series-scalar)."""
    if isinstance(right, (int, float)):
        return left.filter(_OPS[op](F.col(value), F.lit(float(right))))
    r = right.select(*on, F.col(right_value).alias("_rv"))
    return left.join(r, list(on), "inner").filter(_OPS[op](F.col(value), F.col("_rv"))).drop("_rv")


# ---- T13 --------------------------------------------------------------------
def absent_steps(df: DataFrame, series: Sequence[str], ts: str, step_seconds: int, expected: DataFrame | None = None,
                 block: str = "1 DAY") -> DataFrame:
    """``absent()`` per expected series and step, over the whole time range of the table.

    ``expected`` lists the series that should report (else those that ever did); one that stops, starts late or never
    appears is absent at each step it lacks.  Steps are made in (series, block) pieces that Spark deals out, so a long
    range of one series is not one task."""
    observed = df.select(*series, bucket_start(ts, step_seconds).alias("step")).distinct()
    span = observed.agg(F.min("step").cast("timestamp").alias("_lo"), F.max("step").cast("timestamp").alias("_hi"))
    spine = (observed if expected is None else expected).select(*series).distinct()
    blocks = (spine.crossJoin(F.broadcast(span))                      # one row
                   .select(*series, "_hi", F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {block}"))).alias("_from")).repartition(*series, "_from"))
    last = F.least(F.col("_hi"), F.col("_from") + F.expr(f"INTERVAL {block}") - F.expr("INTERVAL 1 MICROSECOND"))
    steps = blocks.select(*series, F.explode(F.sequence("_from", last, F.expr(f"INTERVAL {step_seconds} SECONDS"))).alias("step"))
    return steps.withColumn("step", F.col("step").cast("timestamp_ntz")).join(observed, [*series, "step"], "left_anti").withColumn("absent", F.lit(1))


# ---- T14 --------------------------------------------------------------------
def alert_hold(steps: DataFrame, series: Sequence[str], step: str, cond: str, step_seconds: int,
               hold_seconds: int) -> DataFrame:
    """``for:`` semantics via gaps-and-islands on an evaluation-step table.

    An island is a run of consecutive steps where ``cond`` holds; it fires when
    it lasts at least ``hold_seconds`` (first step + hold <= last step).  The
    window is per series over its *steps* (pre-aggregated), not raw samples.
    """
    t = steps.filter(F.col(cond)).withColumn("_s", F.unix_timestamp(F.col(step).cast("timestamp")))
    w = Window.partitionBy(*series).orderBy("_s")
    isl = t.withColumn("_island", F.col("_s") / F.lit(step_seconds) - F.row_number().over(w))
    g = isl.groupBy(*series, "_island").agg(F.min(step).alias("island_start"), F.max(step).alias("island_end"),
                                            F.count(F.lit(1)).alias("steps"))
    dur = (F.unix_timestamp(F.col("island_end").cast("timestamp"))
           - F.unix_timestamp(F.col("island_start").cast("timestamp")))
    fired = g.filter(dur >= hold_seconds)
    return fired.select(*series, "island_start", "island_end", "steps",
                        (F.col("island_start").cast("timestamp") + F.expr(f"INTERVAL {hold_seconds} SECONDS"))
                        .cast("timestamp_ntz").alias("firing_at"))


# ---- T15 --------------------------------------------------------------------
def alert_catalog(samples: DataFrame, rules: DataFrame, series: str, step_seconds: int = 3600,
                  ts: str = "ts", value: str = "value", metric: str = "metric",
                  order: Column | None = None) -> DataFrame:
    """Evaluate a rule table (alert, metric, matcher, agg, op, threshold, hold_s, severity).

    Per evaluation step the instant vector is the latest sample of every
    series (partial ``max_by``); rules are broadcast (a catalog of tens of
    rules) and select their series by metric and a fully anchored regex on
    the series label; the matching series are aggregated per (rule, step) and
    compared with the threshold; consecutive true steps form runs, and a run
    fires once it has lasted the rule's ``hold_s`` (``for:``).
    """
    step = bucket_start(ts, step_seconds).alias("step")
    key = order if order is not None else F.col(ts)
    inst = samples.groupBy(metric, series, step).agg(F.max_by(value, key).alias(value))
    j = inst.join(bounded_broadcast(rules, 10_000, "alert rules"), metric, "inner") \
        .filter(F.expr(f"`{series}` RLIKE concat('^(?:', matcher, ')$')"))
    g = j.groupBy("alert", "severity", "agg", "op", "threshold", "hold_s", "step").agg(
        F.sum(value).alias("_sum"), F.max(value).alias("_max"), F.avg(value).alias("_avg"),
        F.count(value).alias("_count"))
    v = (F.when(F.col("agg") == "sum", F.col("_sum")).when(F.col("agg") == "max", F.col("_max"))
          .when(F.col("agg") == "avg", F.col("_avg")).otherwise(F.col("_count").cast("double")))
    t = F.col("threshold")
    cond = (F.when(F.col("op") == ">", v > t).when(F.col("op") == ">=", v >= t).when(F.col("op") == "<", v < t)
             .when(F.col("op") == "<=", v <= t).when(F.col("op") == "==", v == t).otherwise(v != t))
    steps = g.select("alert", "severity", "hold_s", "step", cond.alias("cond"))
    t_s = steps.filter("cond").withColumn("_s", F.unix_timestamp(F.col("step").cast("timestamp")))
    isl = t_s.withColumn("_island", F.col("_s") / F.lit(step_seconds)
                         - F.row_number().over(Window.partitionBy("alert").orderBy("_s")))
    runs = isl.groupBy("alert", "severity", "hold_s", "_island").agg(
        F.min("step").alias("island_start"), F.max("step").alias("island_end"), F.count(F.lit(1)).alias("steps"))
    dur = (F.unix_timestamp(F.col("island_end").cast("timestamp"))
           - F.unix_timestamp(F.col("island_start").cast("timestamp")))
    fired = runs.filter(dur >= F.col("hold_s"))
    firing_at = F.timestamp_seconds(F.unix_timestamp(F.col("island_start").cast("timestamp")) + F.col("hold_s"))
    return fired.select("alert", "severity", "island_start", "island_end", "steps",
                        firing_at.cast("timestamp_ntz").alias("firing_at"))
