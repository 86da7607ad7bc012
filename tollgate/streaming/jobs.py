"""Structured Streaming operators.

Sources are file streams over the input tables (``pathGlobFilter`` picks one
table's files out of the shared folder); sinks are parquet folders plus a
checkpoint under the cluster's shared ``spark.checkpoint.dir``.  Every job has
a watermark on each stateful operator, so state is bounded by the lateness
budget, and runs with ``trigger(availableNow=True)`` in tests and the bench
(the same code runs with a processing-time trigger in production).

Append mode emits a window once the watermark passes its end, so a finished
``availableNow`` run holds exactly the windows with
``end <= max(event time) - delay``; the batch twins (oracles) use that rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.functions.exprs import clipped_sigmoid
from tollgate.operators.model import DEFAULT_THRESHOLD, logit_expr
from tollgate.session import checkpoint_root
from tollgate.sources.tables import table


def table_stream(spark: SparkSession, sf: str, name: str, max_files: int | None = None,
                 folder: str | None = None) -> DataFrame:
    """File stream of one table; NTZ timestamps cast to TIMESTAMP (watermarks need it)."""
    schema = table(spark, sf, name).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet" if folder is None else "*.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.parquet(folder or sf)
    for f in schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def _run_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_append(sdf: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """Run an append-mode stream to a parquet sink until all input is processed; read the sink back."""
    spark = sdf.sparkSession
    d = _run_dir(spark, name)
    q = (sdf.writeStream.outputMode("append").format("parquet").option("path", f"{d}/data")
            .option("checkpointLocation", f"{d}/checkpoint").trigger(availableNow=True).start())
    dropped: dict[int, int] = {}                  # by batch: Spark itself keeps the last progress reports only
    ended = False
    while not ended:
        ended = q.awaitTermination(1)
        for p in q.recentProgress:
            n = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
            dropped[p["batchId"]] = max(n, dropped.get(p["batchId"], 0))
    progress = {"dropped_by_watermark": sum(dropped.values())}
    return spark.read.schema(sdf.schema).parquet(f"{d}/data"), progress


def run_foreach_batch(sdf: DataFrame, name: str, fn: Callable[[DataFrame, int], DataFrame],
                      mode: str = "append") -> DataFrame:
    """Run a stream whose micro-batches are transformed by ``fn``.

    A batch owns the folder of its id and overwrites it, so a batch that runs again adds nothing."""
    spark = sdf.sparkSession
    d = _run_dir(spark, name)
    q = (sdf.writeStream.outputMode(mode).foreachBatch(batch_sink(f"{d}/data", fn)).option("checkpointLocation", f"{d}/checkpoint")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{d}/data")


def batch_sink(path: str, fn: Callable[[DataFrame, int], DataFrame]) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that is idempotent by batch id."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        fn(batch, batch_id).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return sink


# ---- W1 / W2 ----------------------------------------------------------------
def stream_score(requests: DataFrame, features: DataFrame, models: DataFrame, key: str = "user_id", feature_key: str = "c_custkey") -> DataFrame:
    """Requests scored with the model version each is routed to (P4 / P5 on a stream or a micro-batch).

    Requests meet the feature table on their key and the model table on (version); neither side is collected, and where both are
    read anew for each micro-batch, a version registered meanwhile scores from the next batch on.  A request of an
    unknown key or an unregistered version stays, with a null score."""
    j = requests.join(features, requests[key] == features[feature_key], "left").join(models, "version", "left")
    known = F.col("bias").isNotNull() & F.col(feature_key).isNotNull()
    score = F.when(known, F.round(clipped_sigmoid(logit_expr()), 6))
    return j.select("request_id", "ts", "version", score.alias("churn_score"), (score >= F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD))).cast("int").alias("high_risk"))


def stream_dedupe(events: DataFrame, key: str = "event_id", delay: str = "120 seconds") -> DataFrame:
    """Drop duplicate keys within the lateness budget (state bounded by the watermark)."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


# ---- W3 / W4 / W8 / W9 ------------------------------------------------------
def stream_window_slo(log: DataFrame, by: Sequence[str], window: str, slide: str | None = None,
                      delay: str = "10 minutes") -> DataFrame:
    """Tumbling or sliding windows of requests, errors and error ratio per service."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    g = log.withWatermark("ts", delay).groupBy(w.alias("w"), *by).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status") != "success").alias("errors"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "requests",
                    "errors", F.round(F.col("errors") / F.col("requests"), 6).alias("error_ratio"))


def stream_asset_trigger(assets: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Per hour, (raw and candidate) or rollback_request fires once when the hour closes."""
    g = assets.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("w")).agg(
        F.bool_or(F.col("asset") == "raw").alias("has_raw"), F.bool_or(F.col("asset") == "candidate").alias("has_candidate"),
        F.bool_or(F.col("asset") == "rollback_request").alias("has_rollback"))
    return g.select(F.col("w.start").alias("window_start"), "has_raw", "has_candidate", "has_rollback",
                    ((F.col("has_raw") & F.col("has_candidate")) | F.col("has_rollback")).alias("fires"))


def stream_drift(log: DataFrame, reference: DataFrame, by: Sequence[str], value: str,
                 window: str = "1 hour", delay: str = "10 minutes", limit: float = 20.0) -> DataFrame:
    """Windowed mean per key vs static reference means (stream-static join on a small table)."""
    g = log.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), *by).agg(
        F.avg(value).alias("window_mean"))
    j = g.join(reference, list(by), "inner")
    delta = F.round(F.col("window_mean") - F.col("reference_mean"), 4)
    return j.select(F.col("w.start").alias("window_start"), *by, F.round("window_mean", 4).alias("window_mean"),
                    delta.alias("delta"), (F.abs(delta) > limit).alias("flagged"))


# ---- W5 ---------------------------------------------------------------------
def stream_last_seen(events: DataFrame, key: str = "asset", ts: str = "ts") -> DataFrame:
    """Last event of each asset over all micro-batches: one state row per asset (run in complete mode)."""
    return events.groupBy(key).agg(F.max(ts).alias("last_ts"))


def watcher_lag(last_seen: DataFrame, budgets: DataFrame) -> DataFrame:
    """Lag of each asset's last event behind the newest event of the stream, against its budget.

    Every watched asset has a row in every report: one without an event in this batch is as late as its
    last event says, one never seen has no lag and is out of its budget.  An asset without a budget has no verdict."""
    newest = last_seen.agg(F.max("last_ts").alias("newest"))
    j = last_seen.join(budgets, "asset", "full").crossJoin(F.broadcast(newest))  # one row
    lag = F.unix_timestamp("newest") - F.unix_timestamp("last_ts")
    return j.select("asset", lag.alias("lag_s"), "budget_s", F.when(F.col("last_ts").isNull(), False).otherwise(lag <= F.col("budget_s")).alias("within_budget"))


# ---- W6 ---------------------------------------------------------------------
def stream_deadline(a: DataFrame, b: DataFrame, key: str, deadline: str, delay: str = "1 hour") -> DataFrame:
    """A without B within the deadline: stream-stream left outer join with an interval bound.

    Both sides carry a watermark, so join state is dropped once an A row can no
    longer match; unmatched A rows are emitted then (with null B).
    """
    aa = a.withWatermark("a_ts", delay)
    bb = b.withWatermark("b_ts", delay)
    cond = ((F.col("a_key") == F.col("b_key")) & (F.col("b_ts") >= F.col("a_ts"))
            & (F.col("b_ts") <= F.col("a_ts") + F.expr(f"INTERVAL {deadline}")))
    return aa.join(bb, cond, "leftOuter")


# ---- W7 ---------------------------------------------------------------------
HOLD_STATE = "service string, start timestamp, fired boolean"


def stream_steps(log: DataFrame, cond: str, step_seconds: int = 60, delay: str = "10 minutes") -> DataFrame:
    """(service, step, holds): whether the condition was true of all rows of a step (run in append mode).

    A step waits in state until the watermark passes its end, so a row inside of the lateness budget is always
    counted, and a hot service is as many groups as it has open steps.  Steps come out in time order over the micro-batches."""
    g = (log.withWatermark("ts", delay).groupBy(F.window("ts", f"{step_seconds} seconds").alias("w"), "service")
            .agg(F.coalesce(F.bool_and(cond), F.lit(False)).alias("holds")))
    return g.select("service", F.col("w.start").alias("step"), "holds")


def hold_runs(steps: DataFrame, state: DataFrame, hold_seconds: int) -> tuple[DataFrame, DataFrame]:
    """Alerts (service, island_start, fired_at) of closed steps, and the state after them: each service's open run.

    A run is a sequence of observed steps that hold; the first run goes on with the state's.  It fires once, at its first step
    that starts ``hold_seconds`` or more after the run.  A step without rows is no evidence: it neither extends nor ends a run."""
    own = Window.partitionBy("service").orderBy("step")
    runs = (steps.join(state, "service", "left").withColumn("run", F.count_if(~F.col("holds")).over(own))
                 .withColumn("first_run", F.col("run") == 0))
    start = F.when(F.col("first_run") & F.col("start").isNotNull(), F.col("start")).otherwise(F.min("step").over(Window.partitionBy("service", "run")))
    held = (runs.filter("holds").select("service", "run", "step", start.alias("start"), (F.col("first_run") & F.coalesce("fired", F.lit(False))).alias("before"))
                .withColumn("long", F.unix_micros("step") - F.unix_micros("start") >= hold_seconds * 1_000_000))
    per_run = held.groupBy("service", "run", "start", "before").agg(F.min(F.when(F.col("long"), F.col("step"))).alias("fired_at"), F.max("step").alias("last"))
    fired = per_run.filter("fired_at is not null and not before").select("service", F.col("start").alias("island_start"), "fired_at")
    newest = steps.groupBy("service").agg(F.max("step").alias("newest"))
    going_on = per_run.join(newest, "service").filter("last = newest").select("service", "start", (F.col("before") | F.col("fired_at").isNotNull()).alias("fired"))
    return fired, going_on.union(state.join(newest, "service", "left_anti").select("service", "start", "fired"))


def run_alert_hold(log: DataFrame, cond: str, hold_seconds: int, name: str, step_seconds: int = 60, delay: str = "10 minutes") -> DataFrame:
    """``for:`` semantics as a stream, independent of how rows fall into micro-batches.

    Spark's window state orders the rows into closed steps; each micro-batch joins its closed steps with the open runs that the batch
    before it left.  Alerts and state are tables by batch id that a repeated batch overwrites, so a retry changes nothing.  The
    state is one row per service."""
    spark = log.sparkSession
    d = _run_dir(spark, name)

    def sink(steps: DataFrame, batch_id: int) -> None:
        before = (spark.read.schema(HOLD_STATE).parquet(f"{d}/state/batch_id={batch_id - 1}") if batch_id
                  else spark.createDataFrame([], HOLD_STATE))
        fired, state = hold_runs(steps, before, hold_seconds)
        fired.write.mode("overwrite").parquet(f"{d}/data/batch_id={batch_id}")
        state.write.mode("overwrite").parquet(f"{d}/state/batch_id={batch_id}")

    q = (stream_steps(log, cond, step_seconds, delay).writeStream.outputMode("append").foreachBatch(sink)
            .option("checkpointLocation", f"{d}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{d}/data").select("service", "island_start", "fired_at")
