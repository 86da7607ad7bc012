"""Skew-safe exact ranks, running sums and nearest-rank percentiles.

A window ``partitionBy(key).orderBy(v)`` puts every row of a key into one task;
with one key holding a third of the data that task is the whole job.  So
``prefix_rank`` uses the window only for keys of a bounded number of rows
(``WINDOW_ROWS``): one shuffle, nothing written.  For the others it:

1. range-partitions the rows on (key, order...) and sorts within partitions --
   one shuffle; a hot key spans many tasks;
2. computes running sums inside each partition in place (a vectorised pandas
   pass over the sorted partition, batch by batch: no second shuffle, and no key
   is held in memory);
3. fixes up the few keys that straddle partition boundaries: only the first
   and last key of a partition can, so that table has at most 2 x partitions
   rows and is broadcast;
4. cum = local running sum + offset.

The range-partitioned input is reliably checkpointed (shared
``spark.checkpoint.dir``) so every pass sees the same partitions, also when an
executor is lost and tasks are recomputed.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tollgate.functions.guards import bounded_broadcast
from tollgate.session import ensure_checkpoint_dir

# The per-partition pandas pass runs in Python workers: ship it by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A key of more rows does not go to one task whole.
WINDOW_ROWS = 1_000_000
#: Keys are counted by hash in so many buckets.
SIZE_BUCKETS = 1 << 16


def split_by_size(df: DataFrame, by: Sequence[str], limit: int, counted: DataFrame | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """``df`` as (keys of at most ``limit`` rows, the other keys); a part that is known to be empty is None.

    Rows are counted by a hash of the key in ``SIZE_BUCKETS`` buckets, so the counts stay small however many keys
    there are; all keys of a bucket over ``limit`` go to the second part, so the first never holds a larger key.
    ``counted`` stands for ``df`` in the count: it must have at least as many rows of each key."""
    bucket = F.pmod(F.xxhash64(*by), F.lit(SIZE_BUCKETS)).alias("_bucket")
    sizes = (df if counted is None else counted).groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    large = [r["_bucket"] for r in sizes.filter(F.col("_n") > limit).select("_bucket").collect()]
    if not large:
        return df, None
    if len(large) == SIZE_BUCKETS:
        return None, df
    t = bounded_broadcast(df.sparkSession.createDataFrame([(b,) for b in large], "_bucket long"), SIZE_BUCKETS, "buckets of large keys")
    at = df.select("*", bucket)
    return at.join(t, "_bucket", "left_anti").select(*df.columns), at.join(t, "_bucket", "left_semi").select(*df.columns)


def range_partition(df: DataFrame, by: Sequence[str], order: Sequence[str],
                    partitions: int | None = None, stable: bool = True) -> DataFrame:
    """Range-partition on (by, order), sort within partitions, tag rows with ``_pid``.

    Without an explicit ``partitions`` there are as many ranges as
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` (else ``spark.sql.shuffle.partitions``) says,
    and AQE merges adjacent small ones up to the advisory size.  It does not split a large one: set that number to the
    largest input over the advisory size.  A range that is too large costs time and sort spill, not memory.  With ``stable`` (several
    passes over the result must see the same partition ids) the result is
    reliably checkpointed into the shared checkpoint dir; a single-pass
    consumer skips that write (a recomputed task reuses the same range
    partitioner, so it lands on the same rows).
    """
    spark = df.sparkSession
    cols = [*by, *order]
    rp = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    out = rp.sortWithinPartitions(*cols).withColumn("_pid", F.spark_partition_id())
    if not stable:
        return out
    ensure_checkpoint_dir(spark)
    return out.checkpoint(eager=True)


def _local_running_sums(by: list[str], weights: list[str]):
    """Running sums per key run inside one sorted partition.

    Batches of one partition arrive in order and leave one by one; only the last key's hash and sums are
    carried, so a key that fills the whole partition needs no more memory than one batch."""
    def fn(batches):
        carry_hash = None
        carry = np.zeros(len(weights), dtype=np.int64)
        for pdf in batches:
            if pdf.empty:
                continue
            h = pd.util.hash_pandas_object(pdf[by], index=False).to_numpy() if by else np.zeros(len(pdf), np.uint64)
            new = np.empty(len(pdf), dtype=bool)
            new[0] = carry_hash is None or h[0] != carry_hash
            new[1:] = h[1:] != h[:-1]
            starts = np.flatnonzero(np.r_[True, new[1:]])
            lengths = np.diff(np.r_[starts, len(pdf)])
            for j, w in enumerate(weights):
                total = np.cumsum(pdf[w].to_numpy(dtype=np.int64))
                before = np.r_[0, total[starts[1:] - 1]]
                if not new[0]:
                    before[0] -= carry[j]
                local = total - np.repeat(before, lengths)
                pdf[f"_l{w}"] = local
                carry[j] = local[-1]
            carry_hash = h[-1]
            yield pdf
    return fn


def _null_safe_join(big: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    s = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                     *[c for c in small.columns if c not in keys])
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(s[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return big.join(s, cond, "left").drop(*[f"_k_{k}" for k in keys])


def prefix_rank(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str | Sequence[str] | None = None,
                partitions: int | None = None, totals: bool = True, counted: DataFrame | None = None) -> DataFrame:
    """Add ``cum`` (inclusive running weight within ``by`` in ``order``), and with ``totals`` ``n`` (group total).

    With several weight columns, adds ``cum_<w>`` and ``n_<w>`` for each.
    Only ascending order; ties in ``order`` must be broken by the caller.
    Keys of up to ``WINDOW_ROWS`` rows are summed by a window, larger ones (all, if ``partitions`` is given, there is no
    key or a weight may be null) over ranges.  ``counted``: rows to count the keys' sizes in, see ``split_by_size``.
    """
    by, order = list(by), list(order)
    weights = [weight] if isinstance(weight, str) or weight is None else list(weight)
    names = ["_w"] if weight is None or isinstance(weight, str) else [f"_w_{w}" for w in weights]
    d = df
    for w, nm in zip(weights, names):
        d = d.withColumn(nm, (F.col(w) if w else F.lit(1)).cast("long"))
    ranges = partitions or not by or any(d.schema[nm].nullable for nm in names)
    small, large = (None, d) if ranges else split_by_size(d, by, WINDOW_ROWS, counted)
    parts = []
    if small is not None:
        parts.append(_rank_by_window(small, by, order, weights, names, totals))
    if large is not None:
        parts.append(_rank_by_ranges(large, by, order, weights, names, partitions, totals))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out if names == ["_w"] else out.drop(*names)


def _rank_by_window(d: DataFrame, by: list[str], order: list[str], weights: list[str | None], names: list[str],
                    totals: bool) -> DataFrame:
    """Running sums of keys that fit one task: one shuffle on the key."""
    key = Window.partitionBy(*by)
    upto = key.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suffixes = ["" if nm == "_w" else f"_{w}" for w, nm in zip(weights, names)]
    cums = [F.sum(nm).over(upto).alias(f"cum{x}") for nm, x in zip(names, suffixes)]
    sums = [F.sum(nm).over(key).alias(f"n{x}") for nm, x in zip(names, suffixes)] if totals else []
    return d.select("*", *cums, *sums)


def _rank_by_ranges(d: DataFrame, by: list[str], order: list[str], weights: list[str | None], names: list[str],
                    partitions: int | None, totals: bool) -> DataFrame:
    """Running sums over sorted ranges, which split a key over tasks.

    Totals are one grouped sum, joined on the key (Spark broadcasts it where it is small)."""
    r = range_partition(d, by, order, partitions)
    p = r.rdd.getNumPartitions()
    # Keys that may straddle a partition boundary: the first and last key of each partition.
    key = F.struct(*[F.col(b) for b in by]) if by else F.lit(0)
    ends = r.groupBy("_pid").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    cand = ends.select("_pid", F.inline(F.array(F.struct(F.col("_first").alias("k")), F.struct(F.col("_last").alias("k")))))
    if by:
        cand = cand.select("_pid", *[F.col(f"k.{b}").alias(b) for b in by]).distinct()
    else:
        cand = cand.select("_pid").distinct()
    span = _null_safe_join(r.select("_pid", *by, *names), bounded_broadcast(cand.withColumn("_c", F.lit(True)),
                                                                             2 * p, "partition-edge keys"),
                           ["_pid", *by]).filter(F.col("_c"))
    tot = span.groupBy("_pid", *by).agg(*[F.sum(nm).alias(f"_p{nm}") for nm in names])
    ow = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", *by,
                      *[F.coalesce(F.sum(f"_p{nm}").over(ow), F.lit(0)).alias(f"_o{nm}") for nm in names])
    schema = StructType([*r.schema.fields, *[StructField(f"_l{nm}", LongType()) for nm in names]])
    local = r.mapInPandas(_local_running_sums(by, names), schema)
    out = _null_safe_join(local, bounded_broadcast(offs, 2 * p, "edge-key offsets"), ["_pid", *by])
    for w, nm in zip(weights, names):
        suffix = "" if nm == "_w" else f"_{w}"
        out = out.withColumn(f"cum{suffix}", F.col(f"_l{nm}") + F.coalesce(F.col(f"_o{nm}"), F.lit(0)))
    if totals:
        sums = r.groupBy(*by).agg(*[F.sum(nm).alias("n" if nm == "_w" else f"n_{w}") for w, nm in zip(weights, names)])
        out = _null_safe_join(out, sums, by) if by else out.crossJoin(bounded_broadcast(sums, 1, "grand total"))
    return out.drop("_pid", *[c for nm in names for c in (f"_l{nm}", f"_o{nm}")])


def _run_gaps(key: str, ts: str):
    """Per key run inside one sorted partition: largest gap between consecutive rows,
    first and last time.  Emits one row per run (carried across batches)."""
    def fn(batches):
        pid = None
        cur = None                      # [hash, key value, first, last, max gap]
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["_pid"].iloc[0])
            h = pd.util.hash_pandas_object(pdf[[key]], index=False).to_numpy()
            t = pdf[ts].to_numpy(dtype=np.int64)
            kv = pdf[key].to_numpy()
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            ends = np.r_[starts[1:], len(pdf)]
            rows = []
            for a, z in zip(starts, ends):
                seg = t[a:z]
                inner = int(np.max(np.diff(seg))) if z - a > 1 else None
                if cur is not None and a == 0 and h[0] == cur[0]:
                    g = int(seg[0] - cur[3])
                    best = max(x for x in (cur[4], inner, g) if x is not None)
                    cur = [cur[0], cur[1], cur[2], int(seg[-1]), best]
                    continue
                if cur is not None:
                    rows.append((pid, cur[1], cur[2], cur[3], cur[4]))
                cur = [h[a], kv[a], int(seg[0]), int(seg[-1]), inner]
            if rows:
                yield pd.DataFrame(rows, columns=["_pid", key, "_first", "_last", "_gi"])
        if cur is not None:
            yield pd.DataFrame([(pid, cur[1], cur[2], cur[3], cur[4])], columns=["_pid", key, "_first", "_last", "_gi"])
    return fn


def max_gap(df: DataFrame, key: str, ts_seconds: str, tiebreak: str, partitions: int | None = None) -> DataFrame:
    """Largest gap between consecutive events per key, skew-safe and without a second shuffle.

    Rows are range-partitioned and sorted on (key, ts); each partition is
    reduced in place (pandas pass) to one row per key run -- largest inner
    gap, first and last time.  Gaps across partition boundaries come from a
    window over that small table (one row per partition and key).
    """
    r = range_partition(df.select(key, ts_seconds, tiebreak), [key], [ts_seconds, tiebreak], partitions, stable=False)
    key_type = r.schema[key].dataType.simpleString()
    runs = r.mapInPandas(_run_gaps(key, ts_seconds),
                         f"_pid int, {key} {key_type}, _first long, _last long, _gi long")
    w = Window.partitionBy(key).orderBy("_pid")
    cross = runs.withColumn("_gc", F.col("_first") - F.lag("_last").over(w))
    return cross.groupBy(key).agg(
        F.greatest(F.coalesce(F.max("_gi"), F.lit(0)), F.coalesce(F.max("_gc"), F.lit(0))).alias("max_gap"))


def _run_deltas(keys: list[str], value: str):
    """Per key run inside one sorted partition: sum of counter deltas between consecutive
    rows (a drop is a reset: the new value counts), first and last value, row count."""
    cols = ["_pid", *keys, "_first_v", "_last_v", "_inner", "_n"]

    def fn(batches):
        pid = None
        cur = None                      # [hash, key values, first, last, inner sum, n]
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["_pid"].iloc[0])
            h = pd.util.hash_pandas_object(pdf[keys], index=False).to_numpy()
            v = pdf[value].to_numpy(dtype=np.float64)
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            ends = np.r_[starts[1:], len(pdf)]
            rows = []
            for a, z in zip(starts, ends):
                seg = v[a:z]
                d = np.where(seg[1:] >= seg[:-1], seg[1:] - seg[:-1], seg[1:])
                inner = float(d.sum()) if len(d) else 0.0
                if cur is not None and a == 0 and h[0] == cur[0]:
                    edge = seg[0] - cur[3] if seg[0] >= cur[3] else seg[0]
                    cur = [cur[0], cur[1], cur[2], float(seg[-1]), cur[4] + edge + inner, cur[5] + (z - a)]
                    continue
                if cur is not None:
                    rows.append((pid, *cur[1], cur[2], cur[3], cur[4], cur[5]))
                cur = [h[a], tuple(pdf[k].iloc[a] for k in keys), float(seg[0]), float(seg[-1]), inner, z - a]
            if rows:
                yield pd.DataFrame(rows, columns=cols)
        if cur is not None:
            yield pd.DataFrame([(pid, *cur[1], cur[2], cur[3], cur[4], cur[5])], columns=cols)
    return fn


def run_summary(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                partitions: int | None = None) -> DataFrame:
    """Per key: counter increase (sum of deltas between consecutive rows in ``order``, resets
    counted as the new value), samples, first and last value; skew-safe and without a second shuffle of the rows.

    Rows are range-partitioned and sorted on (keys, order) and reduced in place
    to one summary per key run; deltas across partition edges come from a
    window over that small table.
    """
    keys = list(keys)
    r = range_partition(df.select(*keys, *[c for c in order if c not in keys], value), keys, list(order), partitions,
                        stable=False)
    schema = ", ".join(["_pid int", *[f"`{k}` {r.schema[k].dataType.simpleString()}" for k in keys],
                        "_first_v double", "_last_v double", "_inner double", "_n long"])
    runs = r.mapInPandas(_run_deltas(keys, value), schema)
    prev = F.lag("_last_v").over(Window.partitionBy(*keys).orderBy("_pid"))
    edge = F.when(prev.isNull(), F.lit(0.0)).when(F.col("_first_v") >= prev, F.col("_first_v") - prev) \
        .otherwise(F.col("_first_v"))
    return runs.withColumn("_edge", edge).groupBy(*keys).agg(
        (F.sum("_inner") + F.sum("_edge")).alias("increase"), F.sum("_n").alias("samples"),
        F.min_by("_first_v", "_pid").alias("first_value"), F.max_by("_last_v", "_pid").alias("last_value"))


def run_increase(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 partitions: int | None = None) -> DataFrame:
    """Counter increase and samples per key (see ``run_summary``)."""
    return run_summary(df, keys, order, value, partitions).drop("first_value", "last_value")


def nearest_rank_index(n: Column, pct: float) -> Column:
    """0-based nearest-rank index: min(round_half_even((n-1)*p), n-1)."""
    return F.least(F.rint((n - 1).cast("double") * F.lit(pct)).cast("long"), n - 1)


def nearest_rank_percentiles(df: DataFrame, value: str, by: Sequence[str] = (),
                             pcts: Sequence[float] = (0.5, 0.95, 0.99), names: Sequence[str] | None = None,
                             digits: int = 4) -> DataFrame:
    """Exact nearest-rank percentiles per group (no interpolation), rounded.

    Rows are first reduced to (group, value) counts (map-side combine), then
    ranked with ``prefix_rank``; the selected value is the first whose running
    count passes the index.  A group has no more values than rows, so its size is
    taken from the rows: the counts are not made twice.
    """
    names = list(names or [f"p{int(round(p * 100))}" for p in pcts])
    rows = df.filter(F.col(value).isNotNull())
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_rank(counts, by, [value], weight="_c", counted=rows)
    picks = []
    for p, name in zip(pcts, names):
        idx = nearest_rank_index(F.col("n"), p)
        hit = (F.col("cum") - F.col("_w") <= idx) & (idx < F.col("cum"))
        picks.append(F.max(F.when(hit, F.col(value))).alias(name))
    out = ranked.groupBy(*by).agg(*picks, F.max("n").alias("samples"))
    return out.select(*by, *[F.coalesce(F.round(F.col(nm), digits), F.lit(0.0)).alias(nm) for nm in names],
                      F.coalesce(F.col("samples"), F.lit(0)).alias("samples"))
