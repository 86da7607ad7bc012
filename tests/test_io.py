"""Sources and sinks: missing CSV path, header-order CSV, whole-file JSON docs, idempotent partition overwrite."""

import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tollgate.operators.training import batch_score
from tollgate.sources import io as sio


def _dir(spark, name):
    from tollgate.session import checkpoint_root
    return os.path.join(checkpoint_root(spark), f"test-{name}-{os.getpid()}-{id(spark)}")


def test_missing_csv_is_empty(spark):
    df = sio.read_csv(spark, "/nonexistent/path/never.csv", ["a", "b"])
    assert df.columns == ["a", "b"] and df.count() == 0


def test_csv_matches_header_names(spark):
    path = _dir(spark, "csv")
    src = spark.createDataFrame([("x", 1.5, 2)], "z string, a double, m int")
    sio.write_csv(src, path)
    back = sio.read_csv(spark, path, ["m", "z", "missing"])
    assert back.collect()[0].asDict() == {"m": "2", "z": "x", "missing": None}
    assert spark.read.option("header", True).csv(path).columns == ["a", "m", "z"]


def test_json_documents_multiline(spark):
    folder = tempfile.mkdtemp(prefix="docs-", dir="/tmp")
    for i in range(3):
        with open(os.path.join(folder, f"r{i}.json"), "w") as f:
            json.dump({"service": f"s{i}", "latency_ms": {"p95": 10.0 * i}}, f, indent=2)
    schema = StructType([StructField("service", StringType()),
                         StructField("latency_ms", StructType([StructField("p95", DoubleType())]))])
    got = sorted((r.service, r.p95) for r in sio.read_json_docs(spark, folder, schema)
                 .select("service", "latency_ms.p95").collect())
    assert got == [("s0", 0.0), ("s1", 10.0), ("s2", 20.0)]


def test_batch_score_dynamic_overwrite_is_idempotent(spark):
    path = _dir(spark, "scores")
    a = spark.createDataFrame([("c1", 0.1, "train"), ("c2", 0.2, "test")], "customer_id string, s double, split string")
    batch_score(a, path)
    b = spark.createDataFrame([("c3", 0.9, "test")], "customer_id string, s double, split string")
    out = batch_score(b, path)            # replaces only the 'test' partition
    assert sorted((r.customer_id, r.split) for r in out.collect()) == [("c1", "train"), ("c3", "test")]
    again = batch_score(b, path)          # re-run: same result
    assert again.count() == 2
    assert again.filter(F.col("split") == "test").collect()[0].customer_id == "c3"


def test_partitioned_scores_prune_on_read(spark):
    path = _dir(spark, "scores-prune")
    rows = [(f"c{i}", i / 10.0, ("train", "validation", "test")[i % 3]) for i in range(30)]
    out = batch_score(spark.createDataFrame(rows, "customer_id string, s double, split string"), path)
    q = out.filter(F.col("split") == "test").select("customer_id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert q.count() == 10
