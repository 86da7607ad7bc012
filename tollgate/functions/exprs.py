"""Scalar column expressions shared by operators (P-family helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def clipped_sigmoid(x) -> Column:
    """1 / (1 + exp(-clamp(x, -35, 35)))."""
    z = F.greatest(F.least(col(x), F.lit(35.0)), F.lit(-35.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def clip(x, lo, hi) -> Column:
    """min(max(x, lo), hi)."""
    return F.least(F.greatest(col(x), F.lit(lo)), F.lit(hi))


def round_up(x, step) -> Column:
    """ceil(x / step) * step (integer result)."""
    return (F.ceil(col(x) / F.lit(step)) * F.lit(step)).cast("long")


def floor_div(num, den, floor: float) -> Column:
    """num / max(den, floor): the reference's guarded ratios (never divides by 0)."""
    return col(num) / F.greatest(col(den), F.lit(floor))


def blank_to_null(x) -> Column:
    """Null-or-empty-string counts as null."""
    c = col(x)
    return F.when(c.cast("string") == "", F.lit(None)).otherwise(c)


def is_blank(x) -> Column:
    c = col(x)
    return c.isNull() | (c.cast("string") == "")


def quantity(x) -> Column:
    """Kubernetes quantity text -> number ('6' -> 6, '750m' -> 0.75, '18Gi' -> 18*2^30)."""
    c = F.trim(col(x).cast("string"))
    num = F.regexp_extract(c, r"^([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
    suf = F.regexp_extract(c, r"^[0-9]+(?:\.[0-9]+)?([A-Za-z]*)$", 1)
    mult = (F.when(suf == "", 1.0).when(suf == "m", 1e-3).when(suf == "k", 1e3)
             .when(suf == "M", 1e6).when(suf == "G", 1e9).when(suf == "T", 1e12)
             .when(suf == "Ki", 1024.0).when(suf == "Mi", 1024.0 ** 2).when(suf == "Gi", 1024.0 ** 3)
             .when(suf == "Ti", 1024.0 ** 4))
    return num * mult


def md5_bucket(key, salt: str) -> Column:
    """Deterministic uniform in [0,1) from md5('<key>:<salt>') (sticky per key)."""
    digest = F.md5(F.concat_ws(":", col(key).cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hour_key(ts) -> Column:
    """Start-of-hour partition key yyyy-MM-ddTHH:00Z."""
    return F.date_format(F.date_trunc("hour", col(ts)), "yyyy-MM-dd'T'HH:00'Z'")


def pinned_tag(uri) -> Column:
    """Tag after the last ':' present and not 'latest' (text after the last colon)."""
    u = col(uri)
    tag = F.substring_index(u, ":", -1)
    return u.contains(":") & ~tag.isin("", "latest")


def redact(attrs, deny: list[str], upserts: dict[str, str]) -> Column:
    """Drop denied keys, then upsert constant attributes (drop + map_concat)."""
    keys = list(deny) + list(upserts)
    kept = F.map_filter(col(attrs), lambda k, v: ~k.isin(*keys))
    if not upserts:
        return kept
    add = F.create_map(*[x for kv in upserts.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.map_concat(kept, add)


def missing_keys(attrs, required: list[str]) -> Column:
    """Required attribute names absent from the map (sorted array)."""
    return F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), F.map_keys(col(attrs))))


def is_numeric_text(x) -> Column:
    """The text parses as a number."""
    return col(x).cast("string").try_cast("double").isNotNull()


def humanize(x, names: dict[str, str]) -> Column:
    """Display name from a lookup, else '_' -> ' '."""
    m = F.create_map(*[F.lit(v) for kv in names.items() for v in kv])
    return F.coalesce(F.element_at(m, col(x)), F.regexp_replace(col(x), "_", " "))


def pack_hex(x) -> Column:
    """Text as binary: lower-case hex digits (ids, digests) at half their length after a 1, other text as UTF-8 after a 0."""
    c = col(x)
    return F.when(F.lower(F.hex(F.unhex(c))) == c, F.concat(F.unhex(F.lit("01")), F.unhex(c))) \
            .otherwise(F.concat(F.unhex(F.lit("00")), c.cast("binary")))


def unpack_hex(x) -> Column:
    """The text of ``pack_hex``."""
    c = col(x)
    return F.when(F.substring(c, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(c.substr(F.lit(2), F.length(c))))) \
            .otherwise(c.substr(F.lit(2), F.length(c)).cast("string"))


EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds_ntz(name: str) -> Column:
    """Whole seconds since 1970-01-01 of a naive (TIMESTAMP_NTZ) wall-clock column, independent of
    the session time zone."""
    return F.expr(f"timestampdiff(SECOND, {EPOCH_NTZ}, `{name}`)")
