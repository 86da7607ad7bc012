"""N-gram Jaccard join by adaptive multi-match prefixes, with classes of linked documents.

A document's set holds the 64-bit hashes of its distinct 3-word shingles.  Two sets of similarity
NUM / DEN or more have at most n - ceil(0.9 n) tokens each that the other lacks.  So with tokens in any one
order, the first p(n) + l - 1 tokens of either (p = n - ceil(0.9 n) + 1) share l tokens or more.

1. Equal sets are one node from the start, known by a 128-bit digest.
2. First round, in the order of the hashes: the prefix is lengthened to 2 p - 1 tokens, about a fifth of a text, and
   p of them must be shared with others.  Only (token, node) of these prefixes are shuffled.  Most documents end here.
3. Second round, on the whole sets of the others, rarest tokens first.  Tokens of one document alone stand
   first and are only counted; documents with p or more of them end here.  Each document's l is then
   the one of least estimated cost: the rows its prefix meets in the token join, plus ``CHECK`` for each pair
   that may be verified, which are at most a l-th of these rows.  A pair is verified if the prefixes of
   its smaller l share that many tokens.
4. A token that more than ``HOT`` prefixes share is not joined with itself.  Its documents are a
   group, and the group has a base: its most usual member, corrected by what more than half of the members differ
   in.  With d(x) tokens by which x differs from the base and F(x) = 19 d(x) - n(x), x and y are similar if and only if
   F(x) + F(y) <= 38 q, where q counts the differences they share (19 = (1 + t) / (1 - t)).  So every link with F(x) + F(y) <= 0
   has its ends linked to the member of least F as well: one star holds them all.  Any other link shares
   q >= (F(x) + F(y)) / 38 differences, which are rare tokens again: they are joined on prefixes of the
   differences, rarest first.  A difference that is itself hot makes a group one level down.
5. Pairs whose ends are connected already are dropped before they are verified.  Links are joined to components.

Defined results: null or blank text has an empty set, n_shingles 0, and is linked with nothing; fewer than 3 words
make one shingle; a null doc_id gets a null component_id and links nothing; repeated rows are members like any other; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import BROADCAST_ROWS, WordHashes, column, semi_by_size, utf8
from tollgate.llm.minhash import components, shingle_set
from tollgate.session import ensure_checkpoint_dir

WORDS, NUM, DEN = 3, 90, 100
#: (1 + t) / (1 - t) for t = NUM / DEN, as a whole number.
WEIGHT = (DEN + NUM) // (DEN - NUM)
#: Prefixes that share a token, beyond which they are a group.  Tokens more that a prefix may take.  Rows of the join one verification costs.
HOT, LONGEST, CHECK = 64, 8, 50
#: Levels of groups inside of groups; what is hot after that is joined as it is.
LEVELS = 4


def prefix(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def _prefix(n: Column) -> Column:
    return n - F.ceil(F.lit(NUM) * n / F.lit(DEN)) + 1


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest and first prefix of each document's set."""
    hashes = WordHashes()
    for b in batches:
        sets = [shingle_set(t, hashes, WORDS) for t in utf8(b, "text")]
        yield pa.record_batch([column(b, "doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                               pa.array([s[:2 * prefix(len(s)) - 1].view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                              names=["doc_id", "n", "digest", "first"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of a node's text; other texts under the same doc_id are left out."""
    hashes = WordHashes()
    for b in batches:
        found = [(i, s) for i, k, t in zip(column(b, "node").to_pylist(), column(b, "digest").to_pylist(), utf8(b, "text"), strict=True)
                 if _digest(s := shingle_set(t, hashes, WORDS)) == k]
        yield pa.record_batch([pa.array([i for i, _ in found], pa.int64()), pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))], names=["node", "s"])


def _distinct_sets(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"), *more)


def _may_match(rows: DataFrame) -> DataFrame:
    """node, digest, first_id of the sets with enough tokens of the first prefix that others have in theirs; nodes are numbered from here on.

    Sets are told apart by 64 bits here, where an error keeps one too many."""
    sets = _distinct_sets(rows, F.max("n").alias("n"), F.first("first").alias("first")).withColumn("id", F.xxhash64("digest"))
    tokens = sets.select("id", F.explode("first").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    met = tokens.join(shared, "token").groupBy("id").agg(F.count("*").alias("met"))
    # A partner may be smaller and have the shorter prefix.
    least = _prefix(F.ceil(F.lit(NUM) * F.col("n") / F.lit(DEN)))
    kept = _distinct_sets(rows, F.max("n").alias("n")).withColumn("id", F.xxhash64("digest")).join(met, "id").filter(F.col("met") >= least)
    return kept.select(F.monotonically_increasing_id().alias("node"), "digest", "first_id").checkpoint()


def _whole_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, n, s: texts are read again for these alone."""
    near = semi_by_size(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), nodes.select(F.col("first_id").alias("doc_id")), "doc_id")
    return (near.join(nodes.select(F.col("first_id").alias("doc_id"), "node", "digest"), "doc_id").select("node", "digest", "text").mapInArrow(_sets, "node long, s array<long>")
            .groupBy("node").agg(F.first("s").alias("s")).withColumn("n", F.size("s").cast("long"))).checkpoint()


def _ordered(sets: DataFrame) -> DataFrame:
    """node, n, alone, shared: the tokens that other sets have too, rarest first, and how many are in no other set."""
    rows = sets.select("node", F.explode("s").alias("token"))
    usual = rows.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    shared = rows.join(usual, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("shared"))
    return shared.join(sets.select("node", "n"), "node").withColumn("alone", F.col("n") - F.size("shared")).filter(F.col("alone") < _prefix(F.col("n")))


def _adaptive(ordered: DataFrame) -> DataFrame:
    """Adds l, the shared tokens to ask for, and ``tokens``, the shared part of the prefix for it."""
    length = lambda l: F.greatest(F.lit(0), _prefix(F.col("n")) + l - 1 - F.col("alone"))  # noqa: E731,E741
    met = lambda l: F.aggregate(F.slice("shared", F.lit(1), length(l).cast("int")), F.lit(0).cast("long"), lambda s, t: s + t["c"] - 1)  # noqa: E731,E741
    cost = F.transform(F.sequence(F.lit(1), F.lit(LONGEST)), lambda l: F.struct((met(l) * (1 + F.lit(float(CHECK)) / l)).alias("cost"), l.alias("l")))  # noqa: E741
    chosen = ordered.withColumn("l", F.array_min(cost)["l"].cast("long"))
    weight = F.aggregate("shared", F.lit(0).cast("long"), lambda s, t: s + t["c"]) / F.col("n")
    return chosen.withColumn("w", weight).withColumn("tokens", F.slice("shared", F.lit(1), length(F.col("l")).cast("int"))).drop("shared")


def _prefix_rows(chosen: DataFrame) -> DataFrame:
    """node, n, l, w, token, at: at is the least l whose prefix holds the token."""
    rows = chosen.select("node", "n", "l", "w", "alone", F.posexplode("tokens").alias("pos", "t"))
    return rows.select("node", "n", "l", "w", F.col("t.token").alias("token"), F.greatest(F.lit(1), F.col("pos") + 2 + F.col("alone") - _prefix(F.col("n"))).alias("at"))


def _sized(rows: DataFrame, key: str) -> DataFrame:
    """Rows with the number of rows of their key, where it is more than one."""
    return rows.join(rows.groupBy(key).agg(F.count("*").alias("m")).filter("m > 1"), key)


def _multi_match(rows: DataFrame) -> DataFrame:
    """(a, b): pairs whose prefixes for the smaller l share that many tokens."""
    x, y = rows.alias("x"), rows.alias("y")
    l = F.least("x.l", "y.l")  # noqa: E741
    sizes = (F.lit(DEN) * F.least("x.n", "y.n") >= F.lit(NUM) * F.greatest("x.n", "y.n"))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & sizes & (F.col("x.at") <= l) & (F.col("y.at") <= l))
    return (met.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count("*").alias("met"), F.first(l).alias("l"))
            .filter("met >= l").select("a", "b"))


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends are not connected yet."""
    return (pairs.join(comp.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
            .join(comp.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left").filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).drop("ra", "rb"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that are similar, on whole sets."""
    pairs = pairs.checkpoint()
    few = semi_by_size(sets, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().checkpoint(), "node")
    side = lambda k: few.select(F.col("node").alias(k), F.col("s").alias(f"s{k}"))
    inter = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (pairs.join(side("b"), "b").join(side("a"), "a").withColumn("inter", inter)
            .filter(F.lit(DEN) * F.col("inter") >= F.lit(NUM) * (F.size("sa") + F.size("sb") - F.col("inter"))).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _based(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """base, node, n, f, diff: members of each group with their differences from the group's base.

    ``rows`` (bucket, node, w).  Buckets of one group agree on a base: the best base of a bucket's members.
    A difference is a token and whether the member has or lacks it, as one hash."""
    base = rows.groupBy("bucket").agg(F.max(F.struct("w", "node")).alias("base"))
    best = rows.join(base, "bucket").groupBy("node").agg(F.max("base").alias("base"))
    agreed = rows.join(best, "node").groupBy("bucket").agg(F.max("base").alias("base"))
    member = rows.join(agreed, "bucket").select(F.col("base.node").alias("base"), "node").distinct().checkpoint()
    few = semi_by_size(sets, member.select(F.explode(F.array("base", "node")).alias("node")).distinct().checkpoint(), "node")
    signed = lambda has, other, more: F.transform(F.array_except(has, other), lambda t: F.xxhash64(t, F.lit(more)))
    raw = (member.join(few.select("node", "n", "s"), "node").join(few.select(F.col("node").alias("base"), F.col("s").alias("b")), "base")
           .select("base", "node", "n", F.concat(signed("s", "b", True), signed("b", "s", False)).alias("diff"))).checkpoint()
    # The base is corrected by what more than half of its group differ in: those differences change sides.
    size = raw.groupBy("base").agg(F.count("*").alias("m"))
    usual = (raw.select("base", F.explode("diff").alias("token")).groupBy("base", "token").agg(F.count("*").alias("c")).filter("c > 1")
             .join(size, "base").filter("2 * c > m").groupBy("base").agg(F.collect_list("token").alias("usual"))).checkpoint()
    many = usual.agg(F.sum(F.size("usual") + 4)).first()[0] or 0
    both = raw.join(F.broadcast(usual) if many <= BROADCAST_ROWS else usual.hint("merge"), "base", "left")
    none = F.array().cast("array<bigint>")
    turned = F.concat(F.array_except("diff", F.coalesce("usual", none)), F.array_except(F.coalesce("usual", none), "diff"))
    return both.select("base", "node", "n", turned.alias("diff")).withColumn("f", F.lit(WEIGHT) * F.size("diff") - F.col("n")).checkpoint()


def _star(group: DataFrame, least: DataFrame) -> DataFrame:
    """Links from each group's member of least F to all whose F is at most its negative."""
    to = group.join(least, "base").filter((F.col("node") != F.col("least.node")) & (F.col("f") + F.col("least.f") <= 0))
    return to.select(F.col("least.node").alias("u"), F.col("node").alias("v"))


def _difference_rows(group: DataFrame, least: DataFrame, comp: DataFrame) -> DataFrame:
    """bucket, base, node, n, f, d, place, root, main: one row for each difference, rarest first, that a link beside the star must share one of.

    A link has an end outside of the star's component.  Links of x share (F(x) + F(y)) / 38 differences or more, whoever y
    is, so one of the first d - m + 1, with m for the least F that a partner can have: one with a difference, and outside of the star's component if x is in it."""
    named = (group.join(least.select("base", F.col("least.node").alias("centre")), "base")
             .join(comp, "node", "left").join(comp.select(F.col("node").alias("centre"), F.col("root").alias("main")), "centre", "left")
             .withColumn("root", F.coalesce("root", "node")).withColumn("main", F.coalesce("main", "centre")).withColumn("d", F.size("diff").cast("long")).filter("d > 0"))
    low = named.groupBy("base").agg(F.min("f").alias("low"), F.min(F.when(F.col("root") != F.col("main"), F.col("f"))).alias("low_loose")).filter("low_loose is not null")
    m = _shared(F.col("f") + F.when(F.col("root") == F.col("main"), F.col("low_loose")).otherwise(F.col("low")))
    each = named.join(low, "base").withColumn("take", F.col("d") - m + 1).select("base", "node", "n", "f", "d", "take", "root", "main", F.explode("diff").alias("token"))
    usual = each.groupBy("base", "token").agg(F.count("*").alias("c"), (F.min("root") != F.max("root")).alias("mixed")).filter("c > 1")
    own = Window.partitionBy("base", "node")
    return (each.join(usual, ["base", "token"]).withColumn("place", F.row_number().over(own.orderBy("c", "token")) + F.col("d") - F.count("*").over(own))
            .filter((F.col("place") <= F.col("take")) & F.col("mixed"))
            .select(F.xxhash64("base", "token").alias("bucket"), "base", "node", "n", "f", "d", "place", "root", "main")).checkpoint()


def _shared(f: Column) -> Column:
    """Differences that members whose F sum up to f share at least, if they are similar."""
    return F.greatest(F.lit(1), F.ceil(f / F.lit(2 * WEIGHT)))


def _pairs_of(rows: DataFrame) -> DataFrame:
    """(a, b) of one bucket in different components, not both in the star's, that F, the sizes and the places of the shared difference allow."""
    loose = rows.filter("root <> main")
    x, y = loose.alias("x"), rows.alias("y")
    sizes = F.lit(DEN) * F.least("x.n", "y.n") >= F.lit(NUM) * F.greatest("x.n", "y.n")
    total = F.col("x.f") + F.col("y.f")
    last = lambda side: F.col(f"{side}.d") - _shared(total) + 1
    met = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.base") == F.col("y.base")) & (F.col("x.root") != F.col("y.root")) & sizes & (total > 0)
                 & (F.col("x.place") <= last("x")) & (F.col("y.place") <= last("y")))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _with_links(comp: DataFrame, links: DataFrame) -> DataFrame:
    return components(comp.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links))


def _with_groups(rows: DataFrame, sets: DataFrame, comp: DataFrame) -> DataFrame:
    """Components with the links inside of the groups (bucket, node, w) added."""
    for level in range(LEVELS):
        group = _based(rows, sets)
        least = group.groupBy("base").agg(F.min(F.struct("f", "node")).alias("least")).checkpoint()
        comp = _with_links(comp, _star(group, least))
        rest = _sized(_difference_rows(group, least, comp), "bucket")
        hot = rest.filter(F.col("m") > HOT).checkpoint() if level < LEVELS - 1 else None
        more = _verified(_apart(_pairs_of(rest if hot is None else rest.filter(F.col("m") <= HOT)), comp), sets).checkpoint()
        if more.head(1):
            comp = _with_links(comp, more)
        if hot is None or not hot.head(1):
            break
        rows = hot.select("bucket", "node", (-F.col("f") / F.col("n")).alias("w"))
    return comp


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sketch, "doc_id long, n long, digest binary, first array<long>").checkpoint()
    nodes = _may_match(rows)
    sets = _whole_sets(docs, nodes)
    prefixes = _sized(_prefix_rows(_adaptive(_ordered(sets))), "token").checkpoint()
    comp = components(_verified(_multi_match(prefixes.filter(F.col("m") <= HOT)), sets))
    hot = prefixes.filter(F.col("m") > HOT).select(F.col("token").alias("bucket"), "node", "w")
    if hot.head(1):
        comp = _with_groups(hot, sets, comp)
    return _label(rows, nodes, comp)


def _label(rows: DataFrame, nodes: DataFrame, comp: DataFrame) -> DataFrame:
    """Classes are named on the distinct sets, so copies of one do not meet; few sets are in a class of several."""
    member = comp.union(comp.select(F.col("root").alias("node"), "root").distinct()).join(nodes, "node")
    least = member.groupBy("root").agg(F.min("first_id").alias("least"))
    classes = member.join(least, "root").select("digest", "least").checkpoint()
    own = _distinct_sets(rows).join(classes, "digest", "left").select("digest", F.coalesce("least", "first_id").alias("least"))
    return (rows.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(own, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id")))
