"""Model registry as an event table: champion/previous state, rollback fold, run log, serving health."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.functions.ranking import prefix_rank


def registry_state(events: DataFrame) -> DataFrame:
    """Champion and previous champion per model from passed promotions (latest first).

    ``row_number() <= 2`` is planned with a partial window-group limit, so a
    model with a huge history ships at most two rows per map task.
    """
    p = events.filter((F.col("event") == "promote") & F.col("gates_passed"))
    w = Window.partitionBy("model").orderBy(F.col("ts").desc(), F.col("version").desc())
    top = p.withColumn("_r", F.row_number().over(w)).filter("_r <= 2")
    return top.groupBy("model").agg(F.max(F.when(F.col("_r") == 1, F.col("version"))).alias("champion"),
                                    F.max(F.when(F.col("_r") == 2, F.col("version"))).alias("previous_champion"))


def registry_fold(events: DataFrame) -> DataFrame:
    """Sequence semantics of promote (passed) / rollback, per model, without collecting histories.

    State (champion, previous): promote v -> (v, champion); rollback swaps when a
    previous exists, else is a no-op.  Closed form on promotion segments
    (segment i = events from the i-th passed promote up to the next): with r_i
    rollbacks in segment i and v_i its version, the champion after segment i is
    v_j for the latest j <= i with r_j even (or j = 1); the previous champion is
    v_i when r_i is odd, else the champion after segment i - 1.

    Segments are numbered with the skew-safe ``prefix_rank``; everything after
    is grouped aggregation (conditional ``max_by``) plus one join of the
    segments with a per-model summary, which AQE's skew join splits for a hot
    model -- no window over a model's whole history.
    """
    e = events.withColumn("_is_p", ((F.col("event") == "promote") & F.col("gates_passed")).cast("int"))
    seg = prefix_rank(e, ["model"], ["ts", "version"], weight="_is_p", totals=False).withColumnRenamed("cum", "seg")
    segs = seg.filter(F.col("seg") >= 1).groupBy("model", "seg").agg(
        F.max(F.when(F.col("_is_p") == 1, F.col("version"))).alias("v"),
        F.count_if(F.col("event") == "rollback").alias("r"))
    keep = (F.col("r") % 2 == 0) | (F.col("seg") == 1)
    last = segs.groupBy("model").agg(F.max("seg").alias("last"), F.max_by("r", "seg").alias("r_last"),
                                     F.max_by("v", "seg").alias("v_last"))
    j = segs.join(last, "model")
    state = j.groupBy("model").agg(
        F.first("last").alias("last"), F.first("r_last").alias("r_last"), F.first("v_last").alias("v_last"),
        F.max_by(F.when(keep, F.col("v")), F.when(keep, F.col("seg"))).alias("champion"),
        F.max_by(F.when(keep & (F.col("seg") < F.col("last")), F.col("v")),
                 F.when(keep & (F.col("seg") < F.col("last")), F.col("seg"))).alias("_c_prev"))
    prev = (F.when(F.col("last") == 1, F.lit(None))
             .when(F.col("r_last") % 2 == 0, F.col("_c_prev")).otherwise(F.col("v_last")))
    state = state.select("model", "champion", prev.alias("previous_champion"),
                         F.col("r_last").alias("trailing_rollbacks"))
    models = events.groupBy("model").agg(F.count(F.lit(1)).alias("events"))
    return models.join(state, "model", "left")


def run_log(metrics: DataFrame, keys: list[str], experiment: str) -> DataFrame:
    """Append-only run records with a deterministic run id (sha256 of experiment and keys)."""
    rid = F.sha2(F.concat_ws(":", F.lit(experiment), *[F.col(k).cast("string") for k in keys]), 256)
    return metrics.select(F.substring(rid, 1, 32).alias("run_id"), F.lit(experiment).alias("experiment_name"), "*")


def append_runs(runs: DataFrame, path: str) -> DataFrame:
    """Appends the runs that the log at ``path`` does not hold yet and returns the whole log.

    Runs are known by ``run_id``: a repeated or retried call adds no row, and a run given more than once counts once.
    The log is a Parquet table that grows by files; only its ids are read for the comparison."""
    reader = runs.sparkSession.read.schema(runs.schema)
    new = runs.dropDuplicates(["run_id"])
    try:
        new = new.join(reader.parquet(path).select("run_id"), "run_id", "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    new.select(*runs.columns).write.mode("append").parquet(path)
    return reader.parquet(path)


def serving_health(expected: DataFrame, log: DataFrame, key: str = "service") -> DataFrame:
    """Deployed (any traffic) and Ready (latest request succeeded) per expected service."""
    last = log.groupBy(key).agg(F.max_by("status", F.struct("ts", "request_id")).alias("_last"))
    j = expected.join(last, key, "left")
    deployed = F.col("_last").isNotNull()
    ready = F.coalesce(F.col("_last") == "success", F.lit(False))
    reason = (F.when(~deployed, "not_deployed").when(~ready, "latest_request_failed").otherwise("Ready"))
    return j.select(key, deployed.alias("deployed"), ready.alias("ready"), reason.alias("reason"))
