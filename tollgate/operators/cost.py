"""Cost attribution, budgets and allocation hygiene.

Samples are pre-aggregated per (labels, node) before the price join, so the
join input is bounded by label combinations x nodes, not by samples; a hot
node is absorbed by the partial aggregate.  Prices are a dimension table:
AQE broadcasts it when small, otherwise it is a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.guards import bounded_broadcast

HOURS_PER_MONTH = 730
GIB = 1024.0 ** 3
# Monthly workload budgets (online serving 420, release training 780, canary analysis 640).
WORKLOAD_BUDGETS = [("churn-risk-online-serving", 420.0), ("airflow-release-training", 780.0),
                    ("kuberay-canary-analysis", 640.0)]
NAMESPACE_BUDGET = sum(b for _, b in WORKLOAD_BUDGETS)  # 1840
# The seven allocation dimensions.
ALLOCATION_DIMENSIONS = ("namespace", "deployment", "service", "label_team", "label_cost_center",
                         "label_model", "label_workload_type")


def money_sum(x) -> "F.Column":
    """Sum of money in exact decimal (order-independent), rounded to cents, as double.

    Float sums depend on partitioning; cost components with few decimals often
    land on half-cents, where a float sum order flips the rounding.
    """
    return F.round(F.sum(x.cast("decimal(38,6)")), 2).cast("double")


def _priced(samples: DataFrame, prices: DataFrame, by: Sequence[str], qty: str, price: str) -> DataFrame:
    pre = samples.groupBy(*by, "node").agg(F.sum(qty).alias("_q"))
    return pre.join(prices.select("node", price), "node", "inner")


def cost_cpu_monthly(samples: DataFrame, prices: DataFrame, by: Sequence[str]) -> DataFrame:
    """C4: sum(cpu * on(node) group_left cpu_h) by (labels) * 730."""
    j = _priced(samples, prices, by, "cpu", "cpu_h")
    return j.groupBy(*by).agg(money_sum(F.col("_q") * F.col("cpu_h") * HOURS_PER_MONTH).alias("cpu_cost"))


def cost_mem_monthly(samples: DataFrame, prices: DataFrame, by: Sequence[str]) -> DataFrame:
    """Memory bytes -> GiB x ram price x 730."""
    j = _priced(samples, prices, by, "mem_bytes", "ram_h")
    return j.groupBy(*by).agg(
        money_sum(F.col("_q") * F.col("ram_h") * HOURS_PER_MONTH / GIB).alias("mem_cost"))


def cost_gpu_monthly(samples: DataFrame, prices: DataFrame, by: Sequence[str]) -> DataFrame:
    """sum(node_gpu_hourly_cost) by (labels, node) * 730 over nodes in use."""
    used = samples.select(*by, "node").distinct()
    j = used.join(prices.select("node", "gpu_h"), "node", "inner").filter(F.col("gpu_h") > 0)
    return j.groupBy(*by, "node").agg(money_sum(F.col("gpu_h") * HOURS_PER_MONTH).alias("gpu_cost"))


def budget_exceeded(cpu: DataFrame, mem: DataFrame, budgets: DataFrame, on: Sequence[str]) -> DataFrame:
    """Cpu + mem cost (vector add = inner join on labels) above the budget; labels without one have the sum of all."""
    j = cpu.join(mem, list(on), "inner").join(budgets, list(on), "left")
    total = F.round((F.col("cpu_cost").cast("decimal(38,6)") + F.col("mem_cost").cast("decimal(38,6)")), 2).cast("double")
    b = F.coalesce(F.col("budget"), F.lit(NAMESPACE_BUDGET))
    return j.select(*on, total.alias("monthly_cost"), b.alias("budget"), (total > b).alias("exceeded"))


def idle_gpu(gpu_cost: DataFrame, usage: DataFrame, on: Sequence[str]) -> DataFrame:
    """GPU cost series unless a positive GPU usage series exists on the same labels."""
    active = usage.filter(F.col("usage") > 0).select(*on).distinct()
    return gpu_cost.join(active, list(on), "left_anti")


def missing_cost_label(samples: DataFrame, label: str = "cost_center") -> DataFrame:
    """Pods without a cost label, counted per namespace (distinct pods)."""
    pods = samples.select("namespace", "pod").distinct()
    labelled = samples.filter(F.col(label).isNotNull() & (F.col(label) != "")).select("namespace", "pod").distinct()
    return (pods.join(labelled, ["namespace", "pod"], "left_anti")
                .groupBy("namespace").agg(F.count(F.lit(1)).alias("pods_missing_label"))
                .withColumn("alert", F.col("pods_missing_label") > 0))


def cost_rollup(samples: DataFrame, prices: DataFrame, sets: Sequence[Sequence[str]],
                dims: Sequence[str] = ALLOCATION_DIMENSIONS) -> DataFrame:
    """Monthly CPU spend over any grouping sets of the allocation dimensions, with grouping_id (bits in their order).

    Quantities are decimals from the first sum on, so cents do not depend on the order of addition.  Samples are summed by
    (dimensions, node) before the price join and before Spark expands them to the sets."""
    pre = samples.groupBy(*dims, "node").agg(F.sum(F.col("cpu").cast("decimal(18,6)")).alias("_q"))
    costed = pre.join(prices.select("node", "cpu_h"), "node").withColumn("cost", F.col("_q") * F.col("cpu_h").cast("decimal(10,6)") * F.lit(HOURS_PER_MONTH))
    return costed.groupingSets([list(s) for s in sets], *dims).agg(
        F.round(F.sum(F.col("cost").cast("decimal(38,6)")), 2).cast("double").alias("spend"), F.grouping_id().cast("int").alias("grouping_id"))
