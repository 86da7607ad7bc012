"""Hard negatives by an R-tree packed with Sort-Tile-Recursive (STR).

Vectors become whole numbers, floor(256 x), so every score is exact.  The tree has three levels:

1. Tiles: Spark cuts all rows into slabs by the label, each slab by the coordinate of the largest variance, each of
   these by the next (STR).  Cuts are quantiles of the slabs, with a hashed fraction that tells equal values apart, so
   tiles are even.  Rows of one vector and label are one entry with its smallest ids, as many as an answer can hold.
2. Inside a tile STR goes on, into leaves of ``LEAF`` entries.
3. The directory holds the minimum bounding box and the label range of each tile; there are at most ``MAX_TILES``.

For a query q a box [lo, hi] gives an interval per coordinate, q_i lo_i to q_i hi_i or the reverse, whose sums
bound the inner products of all its entries.  Boxes are taken from a queue, largest upper end first.  A box
outside of the score window, or strictly below the kth score found so far, is pruned.  A query first looks into its most promising
tile; the kth score it finds there rules out other tiles before anything is sent to them.

Queries are the distinct (vector, label) of the anchors.  Each is searched for its positives, then for
each different positive score for the negatives in that score's window.  Tiles that many queries
look into are copied over as many tasks as the queries need.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no part; a shorter
vector counts as followed by zeros; repeated rows count once; an anchor's other rows are those of other ids;
other columns are ignored; an empty table gives no rows; scores are held within 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.session import ensure_checkpoint_dir

SCALE, POSITIVES, NEGATIVES, ANCHOR_EVERY, RELABEL_EVERY, LABELS = 256, 5, 5, 100, 7, 10
#: Entries of a tile (more, if the directory would exceed MAX_TILES boxes), entries of a leaf, queries of a tile in one task.
TILE, MAX_TILES, LEAF, QUERIES_A_TASK = 4096, 16384, 128, 4096
#: Coordinates the tiles are cut by, after the label.
CUTS = 2
WINDOW = "array<struct<low:long,high:long,kth:long>>"
LONG = np.iinfo(np.int64)


def relabelled(vec_id: Column, label: Column) -> Column:
    return F.when(vec_id % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v): the rows that take part, v in whole numbers; trailing zeros are dropped, so v identifies the vector."""
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    ends = F.array_position(F.transform(F.reverse("v"), lambda x: x != 0), True)
    used = F.when(ends == 0, 0).otherwise(F.size("v") - ends + 1).cast("int")
    return (embeddings.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), relabelled(F.col("vec_id"), F.col("label")).cast("long").alias("label"), whole.alias("v"))
            .withColumn("v", F.slice("v", F.lit(1), used)))


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """(v, label, ids): the ``keep`` smallest ids of each vector and label; more can't be in one answer."""
    first = rows.dropDuplicates(["v", "label", "vec_id"]).withColumn("k", F.row_number().over(Window.partitionBy("v", "label").orderBy("vec_id")))
    return first.filter(F.col("k") <= keep).groupBy("v", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def tiles(entry: DataFrame) -> DataFrame:
    """Entries with their tile: STR by label, then by the coordinates of the largest variance."""
    n = entry.count()
    wide = entry.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") ** 2).alias("q"))
    dims = [r.at for r in wide.orderBy((F.col("q") - F.col("s") ** 2 / F.lit(max(1, n))).desc(), "at").limit(CUTS).collect()]
    slabs = max(1, round((min(MAX_TILES, n / TILE)) ** (1 / (1 + len(dims)))))
    fraction = lambda i: F.pmod(F.xxhash64("v", "label", F.lit(i)), F.lit(1 << 20)) / float(1 << 20)
    out = entry.withColumn("tile", F.lit(0))
    for i, key in enumerate([F.col("label"), *(F.coalesce(F.get("v", F.lit(d)), F.lit(0)) for d in dims)] if slabs > 1 else []):
        out = out.withColumn("t", key.cast("double") + fraction(i))
        cuts = out.groupBy("tile").agg(F.percentile_approx("t", [j / slabs for j in range(1, slabs)]).alias("cuts"))
        above = F.size(F.filter("cuts", lambda c: c < F.col("t")))
        out = out.join(F.broadcast(cuts), "tile").select("v", "label", "ids", (F.col("tile") * slabs + above).cast("int").alias("tile"))
    return out.select("tile", "v", "label", "ids")


class Boxes:
    """Bounding boxes with label ranges; intervals of inner products."""

    def __init__(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.low, self.high, self.least, self.most = low.T, high.T, least, most

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
        return held(up @ self.low + down @ self.high), held(up @ self.high + down @ self.low)

    def of_label(self, label: int, same: bool) -> np.ndarray:
        """Boxes that may hold an entry of the label, or of another one."""
        return (self.least <= label) & (label <= self.most) if same else (self.least != label) | (self.most != label)


def matrix(lists, width: int, dtype) -> np.ndarray:
    out = np.zeros((len(lists), width), dtype=dtype)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def exact(width: int, *tops: int):
    """float64 where sums of products stay whole, else Python's integers."""
    top = max(tops, default=0)
    return np.float64 if width * top * top < 1 << 53 else object


def held(scores: np.ndarray) -> np.ndarray:
    """Scores within 64 bits."""
    return np.minimum(np.maximum(scores, int(LONG.min)), int(LONG.max)) if scores.dtype == object else scores


def largest(lists) -> int:
    return max((abs(int(e)) for v in lists if len(v) for e in (max(v), min(v))), default=0)


def str_order(keys: list[np.ndarray], rows: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Sort-Tile-Recursive: leaves of row numbers."""
    if len(rows) <= leaf:
        return [rows]
    rows = rows[np.argsort(keys[0][rows], kind="stable")]
    if len(keys) == 1:
        return [rows[i:i + leaf] for i in range(0, len(rows), leaf)]
    slabs = int(np.ceil((len(rows) / leaf) ** (1 / len(keys))))
    size = -(-len(rows) // slabs)
    return [x for i in range(0, len(rows), size) for x in str_order(keys[1:], rows[i:i + size], leaf)]


class Tile:
    """The subtree of one tile."""

    def __init__(self, v, label, ids, dtype, width: int):
        x, labels = matrix(v, width, dtype), np.asarray(label, dtype=np.int64)
        spread = x.astype(np.float64).var(axis=0)
        keys = [labels, *(x[:, d].astype(np.float64) for d in np.argsort(-spread, kind="stable")[:CUTS])]
        leaves = str_order(keys, np.arange(len(x)), LEAF)
        self.x, self.labels, self.ids = [x[r] for r in leaves], [labels[r] for r in leaves], [[ids[i] for i in r] for r in leaves]
        self.first = [np.array([i[0] for i in some]) for some in self.ids]
        self.boxes = Boxes(np.stack([b.min(axis=0) for b in self.x]), np.stack([b.max(axis=0) for b in self.x]),
                           np.array([b.min() for b in self.labels]), np.array([b.max() for b in self.labels]))

    def search(self, q: np.ndarray, label: int, windows, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> Iterator[tuple[int, int, int]]:
        """(window's high, id, score) of the first k ids of each window, as far as this tile has them."""
        fits = self.boxes.of_label(label, same)
        queue = [leaf for leaf in np.argsort(-high.astype(np.float64), kind="stable") if fits[leaf]]
        seen: dict[int, np.ndarray] = {}
        for w in windows:
            bottom, top, kth = w["low"], w["high"], w["kth"]
            found: list[tuple[int, int, list[int]]] = []
            for leaf in queue:
                if kth is not None and high[leaf] < kth:
                    break
                if (top is not None and low[leaf] > top) or (bottom is not None and high[leaf] < bottom):
                    continue
                if leaf not in seen:
                    seen[leaf] = held(self.x[leaf] @ q)
                s = seen[leaf]
                good = (self.labels[leaf] == label) == same
                for limit, above in ((top, False), (bottom, True), (kth, True)):
                    if limit is not None:
                        good = good & ((s >= limit) if above else (s <= limit))
                at = np.flatnonzero(good)
                if not len(at):
                    continue
                if len(at) > k:
                    at = at[np.lexsort((self.first[leaf][at], -s[at]))[:k]]
                found = sorted(found + [(-int(s[i]), int(self.first[leaf][i]), self.ids[leaf][i]) for i in at], key=lambda e: e[:2])[:k]
                if len(found) == k and (kth is None or -found[-1][0] > kth):
                    kth = -found[-1][0]
            for s, i in sorted((s, int(i)) for s, _, ids in found for i in ids)[:k]:
                yield top, i, -s


def _route(directory, same: bool, probe: bool, width: int):
    """Queries -> (tile, query with the windows that may be met there); the probe is each window's most promising tile."""
    numbers, boxes, top = directory

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            for begin in range(0, len(d), 256):
                part = d.iloc[begin:begin + 256]
                dtype = exact(width, top, largest(part["v"]))
                low, high = boxes.intervals(matrix(part["v"], width, dtype))
                out = []
                for r, lo, hi in zip(part.itertuples(), low, high, strict=True):
                    fits = boxes.of_label(r.label, same)
                    to: dict[int, list] = {}
                    for w in r.windows:
                        may = fits.copy()
                        if w["high"] is not None:
                            may &= (lo <= w["high"]) & (hi >= w["low"])
                        at = np.flatnonzero(may)
                        if not len(at):
                            continue
                        reach = hi[at] if w["high"] is None else np.minimum(hi[at], w["high"])
                        best = at[np.lexsort((-lo[at].astype(np.float64), -reach.astype(np.float64)))[0]]
                        for t in [best] if probe else at[(at != best) & (True if w["kth"] is None else hi[at] >= w["kth"])]:
                            to.setdefault(int(numbers[t]), []).append(w)
                    out += [(t, r.qid, r.v, r.label, ws) for t, ws in to.items()]
                yield pd.DataFrame(out, columns=["tile", "qid", "v", "label", "windows"])
    return run


def _searcher(same: bool, k: int, width: int):
    def run(entry: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entry) and len(queries):
            dtype = exact(width, largest(entry["v"]), largest(queries["v"]))
            tile = Tile(entry["v"].tolist(), entry["label"], entry["ids"].tolist(), dtype, width)
            for begin in range(0, len(queries), 256):
                part = queries.iloc[begin:begin + 256]
                q = matrix(part["v"], width, dtype)
                low, high = tile.boxes.intervals(q)
                for i, r in enumerate(part.itertuples()):
                    out += [(r.qid, *x) for x in tile.search(q[i], r.label, r.windows, low[i], high[i], same, k)]
        return pd.DataFrame(out, columns=["qid", "high", "id", "score"]).astype({"high": "Int64"})
    return run


class Tree:
    """Tiles as a table, and the directory of their boxes."""

    def __init__(self, entry: DataFrame):
        self.table = tiles(entry.checkpoint()).checkpoint()
        box = (self.table.select("tile", "label", F.explode_outer(F.arrays_zip(F.sequence(F.lit(0), F.size("v")).alias("at"), F.concat("v", F.array(F.lit(0).cast("long"))).alias("x"))).alias("e"))
               .groupBy("tile", F.col("e.at").alias("at")).agg(F.min("e.x").alias("low"), F.max("e.x").alias("high"), F.min("label").alias("least"),
                                                              F.max("label").alias("most"), F.count("*").alias("n")))
        # Bounded: MAX_TILES boxes (and rounding), a few numbers per coordinate; no row of the table.
        rows = box.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("at", "low", "high", "least", "most", "n"))).alias("box")).collect()
        self.width = max((len(r.box) for r in rows), default=0)
        low, high, top = [], [], 0
        for r in rows:
            n = r.box[0].n
            # Entries that end before a coordinate have a zero there.
            low.append([b.low if b.n == n else min(0, b.low) for b in r.box])
            high.append([b.high if b.n == n else max(0, b.high) for b in r.box])
            top = max(top, largest(low[-1:]), largest(high[-1:]))
        kind = exact(self.width, top)
        self.directory = (np.array([r.tile for r in rows]), Boxes(matrix(low, self.width, kind), matrix(high, self.width, kind),
                          np.array([min(b.least for b in r.box) for r in rows]), np.array([max(b.most for b in r.box) for r in rows])), top)

    def _look(self, queries: DataFrame, same: bool, k: int, probe: bool) -> DataFrame:
        sent = queries.mapInPandas(_route(self.directory, same, probe, self.width), f"tile int, qid long, v array<long>, label long, windows {WINDOW}").checkpoint()
        # A row per tile: bounded by the directory.
        load = F.broadcast(sent.groupBy("tile").agg((F.lit(1) + F.count("*") / QUERIES_A_TASK).cast("int").alias("parts")))
        asked = sent.join(load, "tile").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int"))
        held = self.table.join(load, "tile").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return (held.select("tile", "part", "v", "label", "ids").groupBy("tile", "part")
                .cogroup(asked.select("tile", "part", "qid", "v", "label", "windows").groupBy("tile", "part"))
                .applyInPandas(_searcher(same, k, self.width), "qid long, high long, id long, score long"))

    def first(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """(qid, high, id, score, k): the first k ids of each window of the queries (qid, v, label, windows)."""
        own = Window.partitionBy("qid", "high").orderBy(F.desc("score"), "id")
        top = lambda d: d.withColumn("k", F.row_number().over(own)).filter(F.col("k") <= k)
        near = self._look(queries, same, k, True).checkpoint()
        kth = near.groupBy("qid", "high").agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= k)
        known = kth.groupBy("qid").agg(F.collect_list(F.struct("high", "kth")).alias("known"))
        kth_of = lambda w: F.get(F.filter("known", lambda e: e["high"].eqNullSafe(w["high"])), F.lit(0))["kth"]
        rest = (queries.join(known, "qid", "left")
                .withColumn("windows", F.transform("windows", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"), kth_of(w).alias("kth")))))
        far = self._look(rest.select("qid", "v", "label", "windows"), same, k, False)
        return top(near.union(far))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    ensure_checkpoint_dir(embeddings.sparkSession)
    rows = vectors(embeddings)
    tree = Tree(entries(rows, max(POSITIVES + 1, NEGATIVES)))
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0).dropDuplicates(["v", "label", "vec_id"])
    queries = anchors.groupBy("v", "label").agg(F.min(F.xxhash64("vec_id", "v", "label")).alias("qid")).checkpoint()
    of_anchor = anchors.join(queries, ["v", "label"]).select(F.col("vec_id").alias("anchor_id"), "qid")
    everything = F.array(F.struct(*(F.lit(None).cast("long").alias(x) for x in ("low", "high", "kth"))))
    # The anchor itself may be among them, so one more is looked for.
    nearest = tree.first(queries.select("qid", "v", "label", everything.alias("windows")), True, POSITIVES + 1).select("qid", "id", "score")
    own = Window.partitionBy("anchor_id", "qid").orderBy(F.desc("score"), "id")
    positives = (of_anchor.join(nearest, "qid").filter("id <> anchor_id").withColumn("k", F.row_number().over(own))
                 .filter(F.col("k") <= POSITIVES).select("anchor_id", "qid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))).checkpoint()
    # 80 p <= 100 s <= 100 p in whole numbers: p - p div 5 <= s <= p, and nothing where p < 0.
    windows = (positives.filter("positive_score >= 0").select("qid", "positive_score").distinct()
               .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((F.col("positive_score") - F.expr("positive_score div 5")).alias("low"),
                                                                        F.col("positive_score").alias("high"), F.lit(None).cast("long").alias("kth")))).alias("windows")))
    found = tree.first(queries.join(windows, "qid").select("qid", "v", "label", "windows"), False, NEGATIVES)
    negatives = found.select("qid", F.col("high").alias("positive_score"), F.col("k").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(negatives, ["qid", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
