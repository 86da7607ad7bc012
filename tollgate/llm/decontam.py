"""Benchmark decontamination by template windows, in DataFrame functions only.

Texts are read as templates: tokens are runs of letters, numbers, and signs such as %
or $; a number becomes <num>, a unit of measurement <unit>, and a capitalised word
inside a sentence <name>; all else is lower-cased.  In scripts that are written without blanks every letter is
a token.  Every window of ``WINDOW`` template
tokens is hashed; windows of documents meet windows of benchmark items by an equi-join
on the hash.  A benchmark window counts only with ``MIN_WORDS`` different plain words, so
runs of placeholders are no evidence.

Matches of a document and an item on one diagonal (document position less item position) are
one occurrence.  Its slots are consistent if no value of the item (a number, unit or name) stands
for itself in one slot and for another value in a second (another part of the same name is none).  Inserted and removed tokens shift the
rest to other diagonals, so consistent occurrences are also joined: those whose diagonals are within the
item's length, to be held against ``COVER``, and those within ``WINDOW`` tokens, for both limits;
all of them, and those with equal values alone.  An occurrence, alone or joined, is contamination when its
windows cover ``COVER`` of the item's tokens or ``LONG_RUN`` tokens and its slots are consistent, or when they cover
``WHOLE`` of the item with some values changed and others kept.  Equal values make the verdict ``copy``, consistent ones
``reparameterised``, the last kind ``edited``.  The largest one is reported.

Items without a window that counts (short ones, and those of numbers and names alone) are searched whole: documents and items
meet by the hash of the item's first tokens, at most ``WINDOW``, and all of the item's tokens are then compared
by value.  From ``MIN_WORDS`` different tokens on, such an occurrence is a ``copy``.

The benchmark's windows are counted and broadcast only up to ``BROADCAST_ROWS``; beyond
that the join shuffles, where Spark splits hot hashes.

Defined results: null and empty texts have no windows and never match; items of fewer than ``MIN_WORDS`` different
tokens are no evidence; rows with a null doc_id or item_id are left out of
the report, but not of the stage (``decontaminate``); repeated rows report once; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import BROADCAST_ROWS, let, semi_by_size
from tollgate.session import ensure_checkpoint_dir

WINDOW, MIN_WORDS = 8, 4
COVER, LONG_RUN, WHOLE = 0.5, 20, 0.9
NAME_MARK = "\x01"
# Units of measurement and currency.
UNITS = ("mm cm m km in ft yd mi mg g kg lb oz ml l gal s sec secs second seconds min mins minute minutes h hr hrs hour hours day days "
         "week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram "
         "kilograms liter liters litre litres mile miles foot feet inch inches pound pounds dollar dollars cent cents euro euros usd eur gbp "
         "percent degree degrees hz khz mhz ghz kb mb gb tb w kw v").split()
# Scripts that are written without blanks between words.
SOLID = "".join(rf"\p{{Is{script}}}" for script in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
#: The repeated group is possessive: Java recurses into any other, and a line of numbers would end the task.
VALUE = r"\d+(?:[.,]\d+)*+|[%$€£°]"
TOKEN = rf"\x01?[\p{{L}}\p{{M}}]+|{VALUE}"
SOLID_TOKEN = rf"\x01?[a-z[\p{{L}}\p{{M}}&&[^{SOLID}]]]+|[\p{{L}}\p{{M}}&&[{SOLID}]]|{VALUE}"
#: The range comes first, so that scripts are looked up for few characters.
HAS_SOLID = rf"[\x{{0E00}}-\x{{3FFFF}}&&[{SOLID}]]"


def raw_tokens(text: Column) -> Column:
    """Lower-cased tokens; a capitalised word that follows a word, comma or the like carries NAME_MARK."""
    marked = F.regexp_replace(F.translate(text, NAME_MARK, " "), r" (?<=[\p{Ll}\p{N},;] )(?=\p{Lu}\p{Ll})", f" {NAME_MARK}")
    tokens = lambda pattern: F.regexp_extract_all(F.lower(marked), F.lit(pattern), F.lit(0))
    return F.when(text.rlike(HAS_SOLID), tokens(SOLID_TOKEN)).otherwise(tokens(TOKEN))


def kind(token: Column) -> Column:
    """Placeholder of a token, or null for a plain word.  A unit is one only by its word."""
    first = F.substring(token, 1, 1)
    return (F.when(first == NAME_MARK, "<name>").when(first.between("0", "9"), "<num>")
            .when(token.isin(*UNITS, "%", "$", "€", "£", "°"), "<unit>"))


def template(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.coalesce(kind(t), t))


def window_hashes(tokens: Column, n: int = WINDOW) -> Column:
    """Bound once: the optimizer may put the tokens' expression in the place of their column."""
    return let(tokens, lambda t: F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.xxhash64(F.slice(t, i, n)))
                                        ).otherwise(F.array().cast("array<bigint>")))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_tokens, item_raw, w, item_at) of windows that are evidence."""
    items = (benchmark.select("item_id", "text").filter("item_id is not null").distinct()
             .select("item_id", raw_tokens(F.col("text")).alias("item_raw")).withColumn("t", template(F.col("item_raw"))))
    w = items.select("item_id", "item_raw", F.size("t").alias("n_tokens"), "t", F.posexplode_outer(window_hashes(F.col("t"))).alias("item_at", "w"))
    plain = F.filter(F.slice("t", F.col("item_at") + 1, WINDOW), lambda x: ~x.startswith("<"))
    return w.filter(F.size(F.array_distinct(plain)) >= MIN_WORDS).drop("t")


def bare(tokens: Column) -> Column:
    """Tokens without the mark of names: short items are compared by their words alone."""
    return F.transform(tokens, lambda t: F.translate(t, NAME_MARK, ""))


def whole_items(benchmark: DataFrame, windows: DataFrame) -> DataFrame:
    """(item_id, item_bare, n_tokens, lead, w) of the items without a window that counts: hash of the first ``lead`` tokens."""
    items = (benchmark.select("item_id", "text").filter("item_id is not null").distinct().join(windows.select("item_id").distinct(), "item_id", "left_anti")
             .select("item_id", bare(raw_tokens(F.col("text"))).alias("item_bare")).distinct())
    items = items.filter(F.size(F.array_distinct("item_bare")) >= MIN_WORDS).withColumn("n_tokens", F.size("item_bare"))
    items = items.withColumn("lead", F.least("n_tokens", F.lit(WINDOW)))
    return items.withColumn("w", F.xxhash64(F.slice("item_bare", F.lit(1), F.col("lead"))))


def consistent(slots: Column) -> Column:
    """No value of the item stands for itself and for another value; another part of the same name is no other value."""
    items = lambda keep: F.transform(F.filter(slots, keep), lambda s: s["item"])
    return ~F.arrays_overlap(items(lambda s: s["item"] == s["doc"]), items(lambda s: (s["item"] != s["doc"]) & ~s["part"]))


def _in_name(tokens: Column, at: Column, name: Column) -> Column:
    """Whether the token at a place (from 1) and the name are in one run of names, at most two apart."""
    token = lambda k: F.coalesce(F.get(tokens, at - 1 + k), F.lit(""))
    beside = lambda k: (token(k) == name) | (token(k).startswith(NAME_MARK) & (token(2 * k) == name))
    return name.startswith(NAME_MARK) & token(0).startswith(NAME_MARK) & (beside(1) | beside(-1))


def equal(slots: Column) -> Column:
    return F.forall(slots, lambda s: s["item"] == s["doc"])


def _groups(diagonal: Column, n_tokens: Column, same: Column) -> Column:
    """The groups (width, place, only) of an occurrence: its own diagonal (width 0), and for each width the two ranges of twice that
    width that hold its diagonal, so that diagonals within one width of each other share a range; ``only`` for those of equal values."""
    group = lambda width, place, only: F.struct(width.cast("int").alias("width"), place.cast("long").alias("place"), F.lit(only).alias("only"))
    ranges = lambda only: F.array(*[group(w, F.floor(diagonal / w) + k, only) for w in (F.lit(WINDOW), F.greatest(n_tokens, F.lit(WINDOW + 1))) for k in (0, 1)])
    return F.concat(F.array(group(F.lit(0), diagonal, False)), ranges(False), F.when(same, ranges(True)).otherwise(F.slice(ranges(True), 1, 0)))


def contamination(docs: DataFrame, benchmark: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document and item: doc_id, item_id, n_windows, covered, item_tokens, doc_start, doc_end, verdict."""
    with_long = lambda df, key: df.select(F.col(key).cast("long").alias(key), "text")
    return _contamination(with_long(docs, "doc_id"), with_long(benchmark, "item_id"), limit)


def _contamination(docs: DataFrame, benchmark: DataFrame, limit: int) -> DataFrame:
    """The same for (doc_id, text) and (item_id, text) with keys of any type; null keys are left out."""
    ensure_checkpoint_dir(docs.sparkSession)
    windows = item_windows(benchmark)
    short = whole_items(benchmark, windows).checkpoint()
    leads = sorted(r[0] for r in short.select("lead").distinct().collect())  # at most WINDOW numbers
    hashes = windows.select("w").union(short.select("w")).distinct()
    small = hashes.count() <= limit
    starts = lambda raw: [window_hashes(bare(raw), n) for n in leads]
    texts = docs.select("doc_id", "text").filter("doc_id is not null")
    tokens = texts.select("doc_id", raw_tokens(F.col("text")).alias("raw"))
    # The outer form: for a plain explode the optimizer adds a filter that works its array out a second time.
    every = F.concat(window_hashes(template(F.col("raw"))), *starts(F.col("raw"))) if leads else window_hashes(template(F.col("raw")))
    spread = tokens.select("doc_id", F.explode_outer(every).alias("w"))
    hit = spread.join(F.broadcast(hashes) if small else hashes.hint("merge"), "w", "left_semi").select("doc_id").distinct().checkpoint()

    # The few documents with a match are read again, now with positions and slot values.
    near = semi_by_size(texts, hit, "doc_id", limit).distinct().withColumn("raw", raw_tokens(F.col("text")))
    spread = near.select("doc_id", "raw", F.posexplode_outer(window_hashes(template(F.col("raw")))).alias("doc_at", "w"))
    found = spread.join(F.broadcast(windows) if small else windows.hint("merge"), "w")
    same = F.transform(F.sequence(F.lit(1), F.lit(WINDOW)), lambda i: F.struct(
        F.element_at("item_raw", F.col("item_at") + i).alias("item"), F.element_at("raw", F.col("doc_at") + i).alias("doc"),
        (_in_name(F.col("raw"), F.col("doc_at") + i, F.element_at("item_raw", F.col("item_at") + i))
         | _in_name(F.col("item_raw"), F.col("item_at") + i, F.element_at("raw", F.col("doc_at") + i))).alias("part")))
    slots = F.filter(same, lambda s: kind(s["item"]).isNotNull())
    found = found.select("doc_id", "item_id", "n_tokens", "item_at", "doc_at", (F.col("doc_at") - F.col("item_at")).alias("diagonal"), slots.alias("slots"))
    occurrence = found.groupBy("doc_id", "item_id", "n_tokens", "diagonal").agg(
        F.array_sort(F.collect_set("item_at")).alias("at"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    # Occurrences with inconsistent slots stand alone.
    own = _groups(F.col("diagonal"), F.col("n_tokens"), equal(F.col("slots")))
    occurrence = occurrence.select(
        "doc_id", "item_id", "n_tokens", "at", "slots", (F.element_at("at", 1) + F.col("diagonal")).alias("doc_start"),
        (F.element_at("at", -1) + F.col("diagonal") + WINDOW).alias("doc_end"), F.explode(F.when(consistent(F.col("slots")), own).otherwise(F.slice(own, 1, 1))).alias("g"))
    joined = occurrence.groupBy("doc_id", "item_id", "n_tokens", "g").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"),
        F.min("doc_start").alias("doc_start"), F.max("doc_end").alias("doc_end"))
    # Tokens of the item under its matched windows: a window adds what the one before does not reach.
    before = F.concat(F.array(F.lit(-WINDOW)), F.slice("at", 1, F.size("at") - 1))
    covered = F.aggregate(F.zip_with("at", before, lambda x, y: F.least(x - y, F.lit(WINDOW))), F.lit(0), lambda acc, x: acc + x)
    joined = joined.select(
        "doc_id", "item_id", F.col("n_tokens").alias("item_tokens"), F.size("at").alias("n_windows"), covered.alias("covered"), "doc_start", "doc_end",
        F.col("g.width").alias("width"), equal(F.col("slots")).alias("equal"), consistent(F.col("slots")).alias("sound"))
    near_by, share = F.col("width") <= WINDOW, lambda part: F.col("covered") >= part * F.col("item_tokens")
    evidence = joined.filter(F.when(F.col("sound"), share(COVER) | ((F.col("covered") >= LONG_RUN) & near_by)).otherwise(share(WHOLE) & near_by))
    if leads:
        evidence = evidence.unionByName(_whole_occurrences(near, short, leads, small))
    best = evidence.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "covered", (-F.col("width")).alias("narrow"), "equal", "sound", (-F.col("doc_start")).alias("first"), "n_windows", "item_tokens", "doc_end")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.n_windows").cast("long").alias("n_windows"), F.col("b.covered").cast("long").alias("covered"),
                       F.col("b.item_tokens").cast("long").alias("item_tokens"), (-F.col("b.first")).cast("long").alias("doc_start"),
                       F.col("b.doc_end").cast("long").alias("doc_end"), F.when(F.col("b.equal"), "copy").when(F.col("b.sound"), "reparameterised").otherwise("edited").alias("verdict"))


def _whole_occurrences(near: DataFrame, short: DataFrame, leads: list[int], small: bool) -> DataFrame:
    """Items that are compared whole, in documents (doc_id, raw): evidence rows of the first place of each."""
    tokens = near.select("doc_id", bare(F.col("raw")).alias("t"))
    starts = lambda n: F.transform(window_hashes(F.col("t"), n), lambda w, i: F.struct(F.lit(n).alias("lead"), i.alias("at"), w.alias("w")))
    places = F.concat(*[starts(n) for n in leads])
    spread = tokens.select("doc_id", "t", F.explode_outer(places).alias("p")).select("doc_id", "t", "p.*")
    met = spread.join(F.broadcast(short) if small else short.hint("merge"), ["lead", "w"])
    met = met.filter(F.slice("t", F.col("at") + 1, F.col("n_tokens")) == F.col("item_bare"))
    return met.groupBy("doc_id", "item_id", F.col("n_tokens").alias("item_tokens")).agg(F.min("at").alias("doc_start")).select(
        "doc_id", "item_id", "item_tokens", F.lit(1).alias("n_windows"), F.col("item_tokens").alias("covered"), "doc_start",
        (F.col("doc_start") + F.col("item_tokens")).alias("doc_end"), F.lit(0).alias("width"), F.lit(True).alias("equal"), F.lit(True).alias("sound"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without contamination, with all their columns.  Documents and items are known by their texts, so
    every row is judged, also one with a null or repeated id."""
    keyed = lambda df, key: df.select(F.md5(F.col("text").cast("string").cast("binary")).alias(key), "text")
    bad = _contamination(keyed(docs, "doc_id"), keyed(benchmark, "item_id"), BROADCAST_ROWS).select(F.col("doc_id").alias("bad_text")).distinct().checkpoint()
    on = F.md5(docs["text"].cast("string").cast("binary")) == F.col("bad_text")
    return docs.join(F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad.hint("merge"), on, "left_anti")
