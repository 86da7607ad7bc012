"""Physical-plan properties of the registered queries (the scale contract)."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_product(spark, key):
    plan = _plan(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("key", ["recent_predictions", "registry_state", "canary_analysis"])
def test_topk_has_partial_group_limit(spark, key):
    plan = _plan(QUERIES[key](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("key,table,unused", [
    ("cost_cpu_monthly", "lineitem", "l_comment"), ("cost_cpu_monthly", "lineitem", "l_tax"),
    ("label_match", "events", "props"), ("churn_generate", "customer", "c_name"),
])
def test_scans_prune_columns(spark, key, table, unused):
    plan = _plan(QUERIES[key](spark, SF))
    scans = [line for line in plan.split("\n") if "FileScan" in line and f"{table}.parquet" in line]
    assert scans and all(unused not in line for line in scans)
