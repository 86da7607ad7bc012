"""Evidence, governance and traces: reconciliation, decisions, span roll-ups, corpus audits."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.exprs import pack_hex, unpack_hex
from tollgate.functions.ranking import split_by_size
from tollgate.session import ensure_checkpoint_dir

# The per-partition pandas pass of trace_depth runs in Python workers: ship it by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A trace of more spans is not held in one task.
TRACE_ROWS = 100_000


def evidence_reconcile(expected: DataFrame, found: DataFrame, key: str, content: str) -> DataFrame:
    """E5: expected artifacts left-joined with what exists: exists flag, sha256, bytes."""
    f = found.select(key, F.sha2(F.col(content), 256).alias("sha256"),
                     F.length(F.encode(F.col(content), "UTF-8")).alias("bytes"))
    j = expected.join(f, key, "left")
    return j.select(key, F.col("sha256").isNotNull().alias("exists"), "sha256", "bytes")


def governance_decision(gates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Approved iff every gate passed; risk status controlled / blocked / needs_data."""
    g = gates.groupBy(*by).agg(F.bool_and("passed").alias("all_passed"),
                               F.count_if(F.col("observed").isNull()).alias("missing"))
    decision = F.when(F.col("all_passed"), "approved_for_champion").otherwise("rejected")
    risk = (F.when(F.col("missing") > 0, "needs_data").when(F.col("all_passed"), "controlled")
             .otherwise("blocked"))
    return g.select(*by, decision.alias("decision"), risk.alias("risk_status"))


def _packed(spans: DataFrame, *ids: str) -> tuple[DataFrame, list[str]]:
    """Spans with text ids packed for their shuffles, and the names of those ids."""
    text = [c for c in ids if dict(spans.dtypes)[c] == "string"]
    return spans.withColumns({c: pack_hex(c) for c in text}), text


def _unpacked(df: DataFrame, text: Sequence[str]) -> DataFrame:
    return df.withColumns({c: unpack_hex(c) for c in text if c in df.columns})


def trace_rollup(spans: DataFrame) -> DataFrame:
    """Span count, critical path (sum of durations on the chain), root and leaf service.

    Leaves are spans no other span names as parent: a left-anti join on
    (trace_id, span_id), shuffled by trace like the aggregate.
    """
    spans, text = _packed(spans, "trace_id", "span_id", "parent_span_id")
    parents = spans.select("trace_id", F.col("parent_span_id").alias("span_id")).filter(F.col("span_id").isNotNull())
    leaves = spans.join(parents, ["trace_id", "span_id"], "left_anti").groupBy("trace_id").agg(
        F.min("service").alias("leaf_service"), F.count(F.lit(1)).alias("leaves"))
    agg = spans.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("span_count"),
        F.round(F.sum("duration_ms"), 2).alias("critical_path_ms"),
        F.max(F.when(F.col("parent_span_id").isNull(), F.col("service"))).alias("root_service"))
    return _unpacked(agg.join(leaves, "trace_id", "left"), text)


def trace_depth(spans: DataFrame) -> DataFrame:
    """Depth of every span (distance to its root) by pointer doubling.

    Each span keeps an ancestor pointer and its distance to it; every round
    replaces the pointer by the ancestor's pointer and adds the ancestor's
    distance.  Depth d needs about log2(d) rounds instead of d frontier rounds.
    Traces of up to ``TRACE_ROWS`` spans come whole to a task (one shuffle on
    trace_id with hex ids packed, nothing written) and do their rounds there,
    many traces at once; larger ones do each round as a self-join
    (``_depth_by_joins``).  A span below a repeated span id has a row for each
    path to a root, a parent that is not in the trace is one step above, and
    spans on or under a parent cycle get a null depth.
    """
    small, large = split_by_size(spans.select("trace_id", "span_id", "parent_span_id"), ["trace_id"], TRACE_ROWS)
    parts = []
    if small is not None:
        packed, text = _packed(small, *small.columns)
        types = dict(packed.dtypes)
        depths = packed.repartition("trace_id").sortWithinPartitions("trace_id").mapInPandas(
            _depths_of_traces, f"trace_id {types['trace_id']}, span_id {types['span_id']}, depth int")
        parts.append(_unpacked(depths, text))
    if large is not None:
        parts.append(_depth_by_joins(large))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _depths_of_traces(batches):
    """Depths of whole traces, from rows sorted by trace: the last trace of a batch waits for the next one."""
    held = []
    for pdf in batches:
        if pdf.empty:
            continue
        t = pdf["trace_id"].to_numpy()
        last = int(np.flatnonzero(np.r_[True, t[1:] != t[:-1]])[-1])
        if held and held[-1]["trace_id"].iloc[-1] != t[0]:
            yield _depths(pd.concat(held, ignore_index=True))
            held = []
        if last:
            yield _depths(pd.concat([*held, pdf.iloc[:last]], ignore_index=True))
            held = []
        held.append(pdf.iloc[last:])
    if held:
        yield _depths(pd.concat(held, ignore_index=True))


def _depths(pdf: pd.DataFrame) -> pd.DataFrame:
    """Depths of the spans of whole traces, given trace after trace."""
    n = len(pdf)
    t = pdf["trace_id"].to_numpy()
    trace = np.cumsum(np.r_[0, t[1:] != t[:-1]]).astype(np.int64)
    lost = pd.isna(t)                                                 # without a trace no parent is found
    ids, names = pd.factorize(pd.concat([pdf["span_id"], pdf["parent_span_id"]], ignore_index=True))
    ids = ids.astype(np.int64)                                       # -1: null
    key = np.where((ids >= 0) & ~np.r_[lost, lost], np.r_[trace, trace] * max(len(names), 1) + ids, -1)
    me, distinct = pd.factorize(np.where(key[:n] >= 0, key[:n], -2 - np.arange(n)))   # a null id is nobody's parent
    up = pd.Index(distinct).get_indexer(key[n:])
    up[key[n:] < 0] = -1
    depth = (ids[n:] >= 0).astype(np.int64)
    if len(distinct) < n:
        row, depth, ended = _depths_of_repeated(me, up, depth)
        pdf, me = pdf.iloc[row], me[row]
    else:
        anc = up.copy()                                               # ids are numbered by row: an id is its row
        for _ in range(n.bit_length() + 1):
            open_ = np.flatnonzero(anc >= 0)
            if not len(open_):
                break
            to = anc[open_]
            depth[open_], anc[open_] = depth[open_] + depth[to], anc[to]
        ended = anc < 0
    return pd.DataFrame({"trace_id": pdf["trace_id"].to_numpy(), "span_id": pdf["span_id"].to_numpy(),
                         "depth": pd.arrays.IntegerArray(depth.astype(np.int32), ~ended)})


def _depths_of_repeated(me, up, depth):
    """(row, depth, ended) with a row for each path to a root, where span ids come more than once; rows on or under a
    cycle come once, not ended.  ``me``: the row's id; ``up``: its parent's or -1; ``depth``: of the rows without ``up``."""
    order = np.argsort(up, kind="stable")
    lo, hi = (np.searchsorted(up[order], np.arange(me.max() + 1), side) for side in ("left", "right"))

    def children(of):
        """Rows below the ids, and the position of each one's id."""
        count = hi[of] - lo[of]
        at = np.repeat(np.arange(len(of)), count)
        return order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[of][at]], at

    # Rows above which no cycle lies: an id is settled with the last of its rows.
    settled, waiting = up < 0, np.bincount(me)
    rows = np.flatnonzero(settled)
    while len(rows):
        of, less = np.unique(me[rows], return_counts=True)
        waiting[of] -= less
        rows = children(of[waiting[of] == 0])[0]
        settled[rows] = True
    rows = np.flatnonzero(up < 0)
    found = [(rows, depth[rows])]
    while len(rows):
        below, at = children(me[rows])
        keep = settled[below]
        rows, depths = below[keep], found[-1][1][at[keep]] + 1
        found.append((rows, depths))
    rest = np.flatnonzero(~settled)
    row = np.concatenate([*[r for r, _ in found], rest])
    return (row, np.concatenate([*[d for _, d in found], np.zeros(len(rest), np.int64)]),
            np.arange(len(row)) < len(row) - len(rest))


def _depth_by_joins(spans: DataFrame) -> DataFrame:
    """Pointer doubling over all tasks: one self-join on (trace_id, span_id) a round.

    Every round is reliably checkpointed (shared checkpoint dir): the lineage
    stays one join deep and a lost executor only redoes one round.  A chain is
    no longer than its trace has spans, so pointers still open after log2 of
    the largest trace lie on or under a parent cycle.
    """
    ensure_checkpoint_dir(spans.sparkSession)
    parent = F.col("parent_span_id")
    cur = spans.select("trace_id", "span_id", parent.alias("anc"),
                       F.when(parent.isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("depth")).checkpoint(eager=True)
    largest = spans.groupBy("trace_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(largest.bit_length() + 1):
        if cur.filter(F.col("anc").isNotNull()).isEmpty():
            break
        look = cur.select("trace_id", F.col("span_id").alias("anc"), F.col("anc").alias("_anc2"),
                          F.col("depth").alias("_d2"))
        cur = (cur.join(look, ["trace_id", "anc"], "left")
                  .select("trace_id", "span_id", F.col("_anc2").alias("anc"),
                          (F.col("depth") + F.coalesce(F.col("_d2"), F.lit(0).cast("long"))).alias("depth"))
                  .checkpoint(eager=True))
    return cur.select("trace_id", "span_id", F.when(F.col("anc").isNull(), F.col("depth")).cast("int").alias("depth"))


def pattern_audit(corpus: DataFrame, rules: Sequence[tuple[str, str, str]], text: str = "text") -> DataFrame:
    """Rules (rule, mode any/all/none, needle) over a corpus; never concatenates texts.

    Every distinct needle is one conditional count in a single aggregate pass
    over the corpus (whole texts); rules are then decided on that one row.
    """
    needles = sorted({n for _, _, n in rules})
    counts = corpus.agg(*[F.count_if(F.col(text).contains(n)).alias(f"_n{i}") for i, n in enumerate(needles)])
    idx = {n: i for i, n in enumerate(needles)}
    items = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(m).alias("mode"), F.lit(n).alias("needle"),
                               F.col(f"_n{idx[n]}").alias("docs")) for r, m, n in rules])
    j = counts.select(F.inline(items)).withColumn("present", F.col("docs") > 0)
    g = j.groupBy("rule", "mode").agg(F.bool_or("present").alias("any_present"),
                                      F.bool_and("present").alias("all_present"),
                                      F.sum("docs").alias("matching_docs"))
    passed = (F.when(F.col("mode") == "any", F.col("any_present"))
               .when(F.col("mode") == "all", F.col("all_present")).otherwise(~F.col("any_present")))
    return g.select("rule", "mode", passed.alias("passed"), F.col("matching_docs").cast("long").alias("matching_docs"))


def corpus_scorecard(corpus: DataFrame, rules: Sequence[tuple[str, int, str]], group: str, text: str = "text",
                     min_lines: int = 120) -> DataFrame:
    """Per group, rules of AND-ed clauses of OR-ed needles; score and longest document.

    One aggregate per group: ``bool_or(contains(needle))`` for every distinct
    needle and the max line count; clauses and rules are column expressions.
    """
    needles = sorted({n for _, _, n in rules})
    idx = {n: i for i, n in enumerate(needles)}
    g = corpus.groupBy(group).agg(*[F.bool_or(F.col(text).contains(n)).alias(f"_h{i}") for i, n in enumerate(needles)],
                                  F.max(F.size(F.split(F.col(text), "\n"))).alias("max_lines"))
    by_rule: dict[str, dict[int, list[str]]] = {}
    for r, c, n in rules:
        by_rule.setdefault(r, {}).setdefault(c, []).append(n)
    oks = []
    for r, clauses in by_rule.items():
        ok = F.lit(True)
        for needles_in in clauses.values():
            hit = F.lit(False)
            for n in needles_in:
                hit = hit | F.col(f"_h{idx[n]}")
            ok = ok & hit
        oks.append(ok.cast("int"))
    passed = sum(oks[1:], oks[0])
    return g.select(group, passed.alias("rules_passed"), F.lit(len(by_rule)).alias("rules"),
                    F.round(100.0 * passed / len(by_rule), 2).alias("score_pct"), "max_lines",
                    (F.col("max_lines") >= min_lines).alias("long_enough"))


def span_enrich(spans: DataFrame, inventory: DataFrame, key: str = "service") -> DataFrame:
    """Attach inventory metadata (namespace/pod/container) to span attributes (map_concat)."""
    spans, text = _packed(spans, *{"trace_id", "span_id"} - {key})
    j = spans.join(inventory, key, "left")
    meta = F.map_from_arrays(F.array(F.lit("k8s.namespace.name"), F.lit("k8s.pod.name"), F.lit("k8s.container.name")),
                             F.array(F.col("namespace"), F.col("pod"), F.col("container")))
    base = F.create_map(F.lit("service.name"), F.col(key))
    attrs = F.when(F.col("namespace").isNull(), base).otherwise(F.map_concat(base, meta))
    return _unpacked(j.select("trace_id", "span_id", key, attrs.alias("attributes")), text)


def trace_pivot(spans: DataFrame, by: Sequence[str], key: str, value: Column, digits: int = 2) -> DataFrame:
    """Per group a map from each value of ``key`` that the data hold to the sum of ``value``, and the share of its rows.

    No list of values is needed and none is collected: rows are summed by (group, value) first, so a map has one entry
    for each value of its group.  Null keys are under 'unknown'."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("unknown"))
    sums = spans.groupBy(*by, k.alias("_k")).agg(F.sum(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    entry = F.struct(F.col("_k"), F.round("_v", digits).alias("v"))
    return sums.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("pivot"), F.sum("_n").alias("rows"))


def model_card(confusion: DataFrame, features: Sequence[str], by: Sequence[str] = ("model", "version"), segment: str = "segment") -> DataFrame:
    """One row per model version from confusion counts per (version, split, segment): train rows, validation accuracy, and
    the test accuracy of every segment that the data hold, as ``segment=accuracy`` in the order of the segments."""
    accuracy = lambda rows: F.round((F.sum("tp") + F.sum("tn")) / F.greatest(rows, F.lit(1)), 4)
    per = confusion.groupBy(*by, "split", segment).agg(F.sum("rows").alias("rows"), F.sum("tp").alias("tp"), F.sum("tn").alias("tn"), accuracy(F.sum("rows")).alias("acc"))
    of = lambda split, c: F.sum(F.when(F.col("split") == split, F.col(c)))
    tested = F.sort_array(F.collect_list(F.when(F.col("split") == "test", F.struct(F.col(segment).alias("s"), "acc"))))
    card = per.groupBy(*by).agg(of("train", "rows").alias("train_rows"),
                                F.round((of("validation", "tp") + of("validation", "tn")) / F.greatest(of("validation", "rows"), F.lit(1)), 4).alias("validation_accuracy"),
                                F.array_join(F.transform(tested, lambda x: F.concat_ws("=", x["s"], x["acc"].cast("string"))), ",").alias("test_segment_accuracy"))
    return card.select(*by, F.lit(",".join(features)).alias("features"), "train_rows", "validation_accuracy", "test_segment_accuracy")
