"""URL rules by host-suffix and path-prefix expressions.

Each url is expanded into its expressions: every suffix of the host at a dot, with every
prefix of the path that has the length of some rule's path.  An expression is known by
its SHA-256; urls and rules meet by an equi-join on the first 32 bits, and the full
digest confirms the match.  Of a url's rules the longest wins (host plus path; then
the longer host; then block before allow).  Without a rule the verdict is allow.

The rules are counted: up to ``BROADCAST_ROWS`` they are broadcast.  A larger list is joined
by shuffle with the distinct expressions, so a host with a third of all pages meets its
rules once.

Defined results: a null url, or one without ``://``, has an empty host and path, and no
rule fits an empty host; null hosts or paths of rules count as empty, and a rule with an
empty host fits nothing; repeated rules count once; null and repeated page ids are
passed through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import BROADCAST_ROWS

DEFAULT_VERDICT = "allow"
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(c: Column) -> Column:
    return F.translate(c, A_TO_Z, A_TO_Z.lower())


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*+(/[^?#]*)?", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]"""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def url_verdicts(pages: DataFrame, rules: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """pages (page_id, url) and rules (host, path, verdict) -> page_id, host, path, rule, verdict."""
    rules = (rules.select(_lower(F.coalesce("host", F.lit(""))).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
             .filter("r_host <> ''").groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict"))
             .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))).withColumn("short", _short(F.col("r_digest"))))
    n_rules = rules.count()
    # As many as there are lengths of rule paths: a url has no longer prefix than its own path.
    lengths = [r[0] for r in rules.select(F.length("r_path")).distinct().collect()]
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ends = F.filter(F.array(*[F.lit(x) for x in sorted(lengths)]) if lengths else F.array().cast("array<int>"), lambda x: x <= F.length("path"))
    spread = (urls.select("host", "path").filter("host <> ''").distinct()
              .select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("suffix"), ends.alias("ends"))
              .select("host", "path", "suffix", F.explode("ends").alias("end"))
              .select("host", "path", "suffix", F.substring(F.col("path"), F.lit(1), F.col("end")).alias("prefix"))
              .withColumn("digest", _digest(F.col("suffix"), F.col("prefix"))).withColumn("short", _short(F.col("digest"))))
    if n_rules <= limit:
        hits = spread.join(F.broadcast(rules), "short").filter("digest = r_digest")
    else:
        distinct = spread.select("short", "digest").distinct()
        known = distinct.join(rules.hint("merge"), "short").filter("digest = r_digest").drop("short")
        hits = spread.drop("short").join(known.hint("merge"), "digest")
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("a"), F.length("r_host").alias("b"), F.col("r_verdict").alias("c"), F.col("r_host").alias("d"), F.col("r_path").alias("e"))
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.concat(F.col("best.d"), F.col("best.e")).alias("rule"),
        F.coalesce(F.col("best.c"), F.lit(DEFAULT_VERDICT)).alias("verdict"))
