"""Session helpers: sensible defaults for local tests, nothing forced on clusters."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rule, price and model tables are tiny; fact tables never get near this.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "tollgate", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session for tests and the bench."""
    parts = shuffle_partitions or (int(cpus) if str(cpus) != "*" else 8)
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", os.environ.get("TOLLGATE_DRIVER_MEM", "6g")))
    for k, v in {**_LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder and
    is used as is.  Where it is unset, a scratch folder is made on a local master
    only; on a cluster executors would each write to their own disk, so that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that driver and executors share (master {sc.master})")
    path = tempfile.mkdtemp(prefix="tollgate-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables and stream checkpoints."""
    return ensure_checkpoint_dir(spark).rstrip("/")
