"""Deterministic, partitioning-independent pseudo-random numbers.

``F.rand`` depends on partition layout; these depend only on the key, so a
split or a canary assignment is stable under repartitioning and re-runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def uniform(key, seed) -> Column:
    """u(key, seed) = first 8 hex digits of md5('<key>:<seed>') / 2^32, in [0, 1)."""
    k = key if isinstance(key, Column) else F.col(key)
    digest = F.md5(F.concat_ws(":", k.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_32)


def sha_prefix(n: int, *parts) -> Column:
    """First n hex digits of sha256 over ':'-joined parts (span ids)."""
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.substring(F.sha2(F.concat_ws(":", *cols), 256), 1, n)
