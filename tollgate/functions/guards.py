"""Broadcast guard.

A side is broadcast explicitly only when its row count is bounded by
construction (literal policy / registry tables, one-row global aggregates,
one row per registered model version, one row per partition edge).  Every
data-dependent side (a dimension whose size grows with the data) is left to
Catalyst / AQE, which broadcasts it only when its runtime size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int, what: str = "") -> DataFrame:
    """Broadcast a side whose row count is bounded *by construction*.

    For literal policy/registry tables and aggregates with a fixed group set
    (a global aggregate is one row, a threshold grid 41 rows) the bound is
    ``max_rows`` whatever the input size.  Catalyst cannot see this (it
    estimates an aggregate as large as its input without CBO), so the hint is
    given explicitly.  ``max_rows`` documents the bound at the call site.
    """
    if max_rows > 1_000_000:
        raise ValueError(f"{what}: {max_rows} rows is not a broadcast-sized bound")
    return F.broadcast(df)
