"""Near-duplicate classes by MinHash: one-permutation hashing, optimal
densification, banded buckets and star-shaped candidate edges.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.

1. Equal sets are one class from the start: every later step works on the
   distinct sets, known by a 128-bit digest, so thousands of copies cost one row.
2. One pass hashes each set once.  The hash range is cut into ``bands * rows`` bins;
   a bin's minimum is the signature's value.  An empty bin borrows from the first
   non-empty bin of its own random order of the bins (optimal densification).
   ``rows`` values make a bucket key.
3. A bucket does not emit its pairs.  The member that meets most others over all
   its buckets is its hub.  Hubs are handed on once through the members' other buckets, so
   that the buckets of one group of copies agree on one centre, and each member gets one
   edge to the centre.  Edges are confirmed on the full sets; edges to a bucket's own hub
   follow where their ends are not known to be linked to one centre.  Links are joined to
   components.
4. What a star can miss lies between members that are still in different
   components.  A centre may itself be an edited copy, so the group's consensus C, the
   shingles of more than half of its members, takes its place: the member nearest to C gets
   edges to all others.  For a member x let a = |x - C|, r = |C - x|, D the a + r shingles in which it differs
   from C and v = 75 a + 100 r.  Two members with o differences in common are similar if and only if
   v + v' - 175 o <= 25 |C| (``_similar_members``).  So all members near enough to the one of least v are linked to
   it, by their sizes alone, and any other needs common differences with whatever partner it has.  These
   pairs meet in one of the rarest of their differences (``_rarest``), an equi-join, and are then counted, and
   confirmed on the full sets.  No pair of members is tried that shares neither.

With 40 bands of 4 rows a pair at similarity 0.75 shares no bucket with a
probability of 3e-7.

Defined results: null or blank text has an empty set, n_shingles 0, and is linked
with nothing; fewer than 5 words make one shingle; a null doc_id gets a null
component_id and kept = true; repeated rows are members like any other; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import BROADCAST_ROWS, GOLDEN, WordHashes, column, lower_words, mix64, ngram_hashes, semi_by_size, utf8
from tollgate.session import ensure_checkpoint_dir

BANDS, ROWS, WORDS = 40, 4, 5
#: Similarity of 0.75 or more, as a fraction of whole numbers.
NUM, DEN = 75, 100
EDGES_A_PART = 100_000


def shingle_set(text: bytes | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    w = hashes.of(lower_words(text))
    return np.unique(ngram_hashes(w, min(words, len(w)))) if len(w) else w


class OnePermutation:
    """Band keys of a sorted set of hashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 7):
        self.bands, self.rows, k = bands, rows, bands * rows
        self.bounds = np.array([(i << 64) // k for i in range(1, k)], dtype=np.uint64)
        rng = np.random.default_rng(seed)
        self.order = np.stack([rng.permutation(k) for _ in range(k)])

    def keys(self, s: np.ndarray) -> np.ndarray:
        at = np.concatenate(([0], np.searchsorted(s, self.bounds), [len(s)]))
        full = at[1:] > at[:-1]
        sig = s[np.minimum(at[:-1], len(s) - 1)]
        if not full.all():
            empty, donors = np.flatnonzero(~full), np.flatnonzero(full)
            sig[empty] = sig[donors[np.argmin(self.order[empty][:, donors], axis=1)]]
        sig = sig.reshape(self.bands, self.rows)
        h = np.arange(1, self.bands + 1, dtype=np.uint64)
        for j in range(self.rows):
            h = mix64(h * GOLDEN + sig[:, j])
        return h


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, opm = WordHashes(), OnePermutation()
    for b in batches:
        n, node, keys = [], [], []
        for t in utf8(b, "text"):
            s = shingle_set(t, hashes)
            n.append(len(s))
            node.append(_digest(s) if len(s) else None)
            keys.append(opm.keys(s).view(np.int64) if len(s) else None)
        yield pa.record_batch([column(b, "doc_id"), column(b, "text_hash"), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                               pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "n_shingles", "node", "keys"])


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of a node's text; other texts under the same doc_id are left out."""
    hashes = WordHashes()
    for b in batches:
        sets = [(k, s) for k, t in zip(column(b, "node").to_pylist(), utf8(b, "text"), strict=True)
                if _digest(s := shingle_set(t, hashes)) == k]
        yield pa.record_batch([pa.array([k for k, _ in sets], pa.binary()), pa.array([s.view(np.int64) for _, s in sets], pa.list_(pa.int64()))],
                              names=["node", "s"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (u, v): each node with the smallest node it reaches.

    Alternates large-star and small-star steps, each a grouped minimum and an
    equi-join, written to the shared checkpoint folder; ends when the edges no
    longer change.  Nothing but two numbers per round reaches the driver."""
    ensure_checkpoint_dir(edges.sparkSession)
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    e = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()).checkpoint()
    seen = mark(e)
    # The edges never become more, so the first count sizes the written partitions of every round.
    parts = 8 + seen[0] // EDGES_A_PART
    e = e.coalesce(parts)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = (small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
             .union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()).coalesce(parts).checkpoint()
        now = mark(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def _release(df: DataFrame) -> None:
    """Shuffle files of steps that are checkpointed have no reader left; Spark removes them when the
    driver's collector finds them, so on a long job it is asked to look."""
    df.sparkSession.sparkContext._jvm.System.gc()


def _similar(inter, size_a, size_b):
    return F.lit(DEN) * inter >= F.lit(NUM) * (size_a + size_b - inter)


def _confirm(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds the exact intersection to edges (a, b, ...); sets travel once per edge at most."""
    with_b = edges.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    return both.withColumn("inter", F.size(F.array_intersect("sa", "sb")).cast("long"))


def _cost(a: Column, r: Column) -> Column:
    return F.lit(NUM) * a + F.lit(DEN) * r


def _similar_members(cost_x: Column, cost_y: Column, common: Column) -> Column:
    """Are members x, y of one group similar, given how many differences from its consensus C they share?

    With i common shingles that both lack and q that both add, |x ^ y| = ax + ay - 2q + rx + ry - 2i and
    |x | y| = |C| - i + ax + ay - q; similar means |x ^ y| <= (1 - t) |x | y|, which is
    t (ax + ay) + rx + ry - (1 + t)(i + q) <= (1 - t) |C|.  So an upper bound of ``common`` makes it a necessary condition."""
    return cost_x + cost_y - F.lit(DEN + NUM) * common <= F.lit(DEN - NUM) * F.col("n_hub")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _classes(docs).drop("text_hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The kept documents with all their columns: of each class one row, of the smallest
    doc_id; rows with a null doc_id all stay."""
    kept = (_classes(docs).filter("kept and doc_id is not null").groupBy(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
            .agg(F.count("*").alias("copies"))).checkpoint()
    on = (docs["doc_id"].cast("long") == F.col("k_id")) & (F.xxhash64(docs["text"]) == F.col("k_hash"))
    once = kept.filter("copies = 1")
    many = kept.filter("copies > 1")
    semi = lambda k: docs.join(F.broadcast(k) if k.count() <= BROADCAST_ROWS else k.hint("merge"), on, "left_semi")
    out = docs.filter(F.col("doc_id").isNull()).union(semi(once))
    return out.union(semi(many).dropDuplicates(["doc_id", "text"])) if many.head(1) else out


def _classes(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _sketch, "doc_id long, text_hash long, n_shingles long, node binary, keys array<long>").checkpoint()
    reps = (rows.filter("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"),
                                                                 F.first("keys").alias("keys"))).checkpoint()
    entry = reps.select("node", "n", F.explode("keys").alias("key"))
    shared = entry.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    entry = entry.join(shared, "key").checkpoint()
    weight = entry.groupBy("node").agg(F.sum("m").alias("w"))
    hubs = entry.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", "node", "n")).alias("hub")).checkpoint()
    best = entry.join(hubs, "key").groupBy("node").agg(F.max("hub").alias("hub"))
    centres = entry.join(best, "node").groupBy("key").agg(F.max("hub").alias("hub"))
    star, local = _spokes(entry, centres).checkpoint(), _spokes(entry, hubs)
    near = local.join(star.select("a", "b"), ["a", "b"], "left_anti").checkpoint()

    del entry, shared, weight, hubs, best, centres, local
    _release(docs)

    # The sets of all nodes with a candidate edge: texts are hashed anew for these alone.
    ends = star.select("a", "b").union(near.select("a", "b"))
    wanted = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    first = reps.join(wanted, "node", "left_semi").select("node", "first_id").checkpoint()
    texts = semi_by_size(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                         first.select(F.col("first_id").alias("doc_id")), "doc_id")
    sets = _sets_of(texts, first)

    starred = _confirm(star, sets).select(
        "a", "b", "na", "nb", "inter", F.array_except("sb", "sa").alias("added"), F.array_except("sa", "sb").alias("removed")).checkpoint()
    # A centre may itself be an edited copy: the member nearest to the consensus of each group gets its edges as well,
    # and so does a bucket's own hub, but for ends that are known to be linked to one centre.
    links = _links(starred)
    group = _from_consensus(starred, _shifts(starred))
    closeness = (F.col("n") - F.col("a")) / (F.col("n_hub") + F.col("a"))
    nearest = group.groupBy("hub").agg(F.max(F.struct(closeness.alias("s"), "node", "n")).alias("near"),
                                       F.min(F.struct(_cost(F.col("a"), F.col("r")).alias("v"), "node")).alias("least")).checkpoint()
    second = (_with_small(group.select("hub", "node", "n"), nearest, "hub").filter("node <> near.node")
              .select(F.col("near.node").alias("a"), F.col("near.n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb")))
    _release(docs)
    labels = links.groupBy(F.col("v").alias("node")).agg(F.max("u").alias("root"))
    links = (links.union(_links(_confirm(_apart(near.union(second.select(*near.columns)).distinct(), labels), sets)))
             .union(_near_least(group, nearest))).checkpoint()
    comp = components(links)
    _release(docs)
    rest = _apart(_rest(group, nearest, comp), comp).join(near.select("a", "b"), ["a", "b"], "left_anti")
    # Few pairs are left: their sets are picked out before the joins.
    rest = rest.checkpoint()
    few = semi_by_size(sets, rest.select(F.explode(F.array("a", "b")).alias("node")).distinct().checkpoint(), "node")
    more = _links(_confirm(rest, few).withColumn("na", F.size("sa").cast("long")).withColumn("nb", F.size("sb").cast("long"))).checkpoint()
    if more.head(1):
        comp = components(comp.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))
    return _label(rows, comp)


def _spokes(entry: DataFrame, hubs: DataFrame) -> DataFrame:
    """Edges (a, b) from the hub of each bucket to its members."""
    return (entry.join(hubs, "key").filter("node <> hub.node")
            .select(F.col("hub.node").alias("a"), F.col("hub.n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb")).distinct())


def _links(confirmed: DataFrame) -> DataFrame:
    return confirmed.filter(_similar(F.col("inter"), F.col("na"), F.col("nb"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _apart(edges: DataFrame, comp: DataFrame) -> DataFrame:
    """Edges whose ends are in different components."""
    return (edges.join(comp.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
            .join(comp.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
            .filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).drop("ra", "rb"))


def _sets_of(near: DataFrame, first: DataFrame) -> DataFrame:
    """node -> set, read from one document of each node."""
    return (near.join(first.select(F.col("first_id").alias("doc_id"), "node"), "doc_id").select("node", "text")
            .mapInArrow(_sets, "node binary, s array<long>")
            .groupBy("node").agg(F.first("s").alias("s"))).checkpoint()


def _with_small(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Equi-join: the other side is counted, and broadcast only up to BROADCAST_ROWS rows of a few numbers each."""
    return df.join(F.broadcast(other) if other.count() <= BROADCAST_ROWS else other.hint("merge"), on)


def _shifts(starred: DataFrame) -> DataFrame:
    """For each hub with a member unlike it: what its members' consensus has more and less than the hub.

    The consensus holds the shingles that more than half of the members have.  Only deviations from the hub are
    counted, by (hub, shingle), so a hot hub is spread over all tasks."""
    unlike = F.max(~_similar(F.col("inter"), F.col("na"), F.col("nb")))
    members = starred.groupBy("a").agg(F.count("*").alias("m"), unlike.alias("loose")).filter("m > 1 and loose").select("a", "m").checkpoint()
    group = semi_by_size(starred, members.select("a"), "a")
    deviation = (group.select("a", F.explode("added").alias("shingle"), F.lit(True).alias("more"))
                 .union(group.select("a", F.explode("removed").alias("shingle"), F.lit(False).alias("more"))))
    common = (_with_small(deviation.groupBy("a", "shingle", "more").agg(F.count("*").alias("c")).filter("c > 1"), members, "a").filter("2 * c > m")
              .groupBy("a").agg(F.collect_list(F.when(F.col("more"), F.col("shingle"))).alias("more"),
                                F.collect_list(F.when(~F.col("more"), F.col("shingle"))).alias("less")))
    none = F.array().cast("array<bigint>")
    return members.select("a").join(common, "a", "left").select("a", F.coalesce("more", none).alias("more"), F.coalesce("less", none).alias("less")).checkpoint()


def _from_consensus(starred: DataFrame, shifts: DataFrame) -> DataFrame:
    """Members (node, n) of those hubs, with size and shingles of what they add to the consensus and lack of it."""
    hashes = shifts.agg(F.sum(F.size("more") + F.size("less") + 4)).first()[0] or 0
    return starred.join(F.broadcast(shifts) if hashes <= BROADCAST_ROWS else shifts.hint("merge"), "a").select(
        F.col("a").alias("hub"), F.col("b").alias("node"), F.col("nb").alias("n"),
        (F.col("na") + F.size("more") - F.size("less")).alias("n_hub"),
        F.concat(F.array_except("added", "more"), F.array_except("less", "removed")).alias("added"),
        F.concat(F.array_except("removed", "less"), F.array_except("more", "added")).alias("removed")
    ).withColumn("a", F.size("added").cast("long")).withColumn("r", F.size("removed").cast("long"))


def _near_least(group: DataFrame, nearest: DataFrame) -> DataFrame:
    """Links of a hub's members to the one of least cost, where their costs alone show that they are similar."""
    return (_with_small(group.select("hub", "node", "n_hub", _cost(F.col("a"), F.col("r")).alias("v")), nearest.select("hub", "least"), "hub")
            .filter(F.col("node") != F.col("least.node")).filter(_similar_members(F.col("v"), F.col("least.v"), F.lit(0)))
            .select(F.col("least.node").alias("u"), F.col("node").alias("v")))


def _rest(group: DataFrame, nearest: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs of one hub's members in different components that are similar by their differences from the consensus."""
    roots = lambda key, name: comp.select(F.col("node").alias(key), F.col("root").alias(name))
    named = (_with_small(group.select("hub", "node", "n_hub", "a", "r", "added", "removed"),
                         nearest.select("hub", F.col("near.node").alias("centre"), F.col("least.v").alias("least")), "hub")
             .join(roots("node", "root"), "node", "left").join(roots("centre", "main"), "centre", "left")
             .withColumn("root", F.coalesce("root", "node")).withColumn("main", F.coalesce("main", "centre")).withColumn("v", _cost(F.col("a"), F.col("r"))))
    # A member in the component of the group's nearest member needs a partner outside of it: those come first.
    loose = named.filter("root <> main")
    members = semi_by_size(named, loose.select("hub").distinct().checkpoint(), "hub")
    spare = F.lit(DEN - NUM) * F.col("n_hub")
    # More common differences than these, of whatever kind, no partner can spare it.
    any_kind = F.ceil((F.col("v") + F.col("least") - spare) / F.lit(DEN + NUM))
    # With a common added shingle: t q >= ... whatever both lack.
    both_add = F.greatest(any_kind - F.col("r"), F.ceil((F.lit(NUM) * F.col("a") + F.lit(DEN - NUM) * F.col("r") - spare) / F.lit(DEN)))
    by_added = _meet(members, "added", both_add, F.least("x.a", "y.a") + F.least("x.r", "y.r"))
    # Without one, both must lack enough of the consensus, and neither adds much.
    both_lack = F.greatest(any_kind, F.ceil((F.col("v") - spare) / F.lit(NUM)))
    by_removed = _meet(members.filter(F.lit(NUM) * F.col("a") + F.lit(DEN - NUM) * F.col("r") <= spare), "removed", both_lack, F.least("x.r", "y.r"))
    pairs = by_added.union(by_removed)
    return pairs.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()


def _meet(members: DataFrame, kind: str, need: Column, most: Column) -> DataFrame:
    """Similar pairs (node, other) of different components with a common one of their rarest shingles of a kind; ``most`` bounds their common differences."""
    rare = _rarest(members, kind, need)
    x, y = rare.filter("root <> main").alias("x"), rare.drop("n_hub").alias("y")
    apart = (F.col("x.hub") == F.col("y.hub")) & (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") != F.col("y.root"))
    meet = (x.join(y, apart & _similar_members(F.col("x.v"), F.col("y.v"), most))
            .select("x.hub", "x.node", F.col("y.node").alias("other")).distinct().checkpoint())
    ends = semi_by_size(members, meet.select(F.explode(F.array("node", "other")).alias("node")).distinct().checkpoint(), "node")
    x_end, y_end = (ends.select("hub", F.col("node").alias(name), "n_hub", F.col("v").alias(f"v_{name}"), F.concat("added", "removed").alias(f"d_{name}")) for name in ("node", "other"))
    common = F.size(F.array_intersect("d_node", "d_other")).cast("long")
    return (meet.join(y_end.drop("n_hub"), ["hub", "other"]).join(x_end, ["hub", "node"])
            .filter(_similar_members(F.col("v_node"), F.col("v_other"), common)).select("node", "other"))


def _rarest(members: DataFrame, kind: str, need: Column) -> DataFrame:
    """(hub, node, root, main, n_hub, a, r, v, shingle) of the shingles added or removed that a similar pair must meet in.

    By ``_similar_members`` a member of cost v with a partner of cost v' needs q + i >= (v + v' - (1 - t)|C|) / (1 + t), where v' is
    the group's least cost or more, and also t q + i or more, as the partner has the common differences too.  So it needs
    q >= t a + (1 - t)(r - |C|), as i <= r; and with q = 0, t i >= v - (1 - t)|C|.
    Members that would need none are all linked to the one of least cost, so of two in different components one needs some.
    With the shingles of a hub in one order, the rarest first, two sets with k or more in common meet in the first
    size - k + 1 of either.  So a shingle that many members share is joined only for members that need it.
    Shingles of one member alone stand first and meet nothing; they are only counted."""
    each = members.withColumn("need", F.greatest(F.lit(1), need)).withColumn("size", F.size(kind)).filter("need <= size").select(
        "hub", "node", "root", "main", "n_hub", "a", "r", "v", "need", "size", F.explode(kind).alias("shingle"))
    shared = each.groupBy("hub", "shingle").agg(F.count("*").alias("c")).filter("c > 1")
    own = Window.partitionBy("hub", "node")
    return (each.join(shared, ["hub", "shingle"]).withColumn("alone", F.col("size") - F.count("*").over(own))
            .withColumn("place", F.row_number().over(own.orderBy("c", "shingle")) + F.col("alone"))
            .filter("place <= size - need + 1").drop("need", "size", "c", "alone", "place")).checkpoint()


def _label(rows: DataFrame, comp: DataFrame) -> DataFrame:
    member = (rows.select("doc_id", "text_hash", "n_shingles", "node").join(comp, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    least = member.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return (member.join(least, "root", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))))
            .select("doc_id", "text_hash", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
