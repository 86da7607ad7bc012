"""Spelling variants by asymmetric q-chunks: words at edit distance one are found by an equi-join and verified.

Words come from runs of Latin letters.  Of two near words the shorter (or each, at equal
length) contributes two disjoint chunks, its halves; the other contributes positional
grams.  One edit touches one half only, so the other half is a gram of the other word: the head at
position 0, the tail shifted by the difference of the lengths, 0 or 1.  Grams at other
positions or of other lengths fail the shift condition whatever the words are, so they are not
made.  Joined words are verified by their edit distance.

A half that very many words share (a frequent ending) would pair them all.  In such a bucket the
same step is taken again on what is left of the words: again one of two chunks is kept, and the
key grows to three quarters of the word, and so on.  ``PAIRS`` bounds the comparisons a row takes
part in on average; no bucket is cut.

Words are counted in tasks before they are shuffled, so frequent words make no hot key.  Forms
strictly gain in occurrences by a factor, so roots are found by doubling pointers in few rounds.

Defined results: null and empty texts have no runs; a null doc_id counts as the empty text in
the hash; repeated rows count each; other columns are ignored; an empty table gives no rows;
a text of any length is cut into blocks between its runs, and a word of any length is compared whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import column, utf8
from tollgate.session import ensure_checkpoint_dir

MIN_LENGTH, MIN_COUNT, RATIO, DROP_EVERY = 6, 5, 5, 199
#: Comparisons per row of a bucket beyond which its words are told apart by more of their letters.
PAIRS = 20
#: Words a task holds before it hands on its counts; bytes of a text looked at once.
HELD, BLOCK = 400_000, 1 << 22
#: Runs of fewer letters give no word, with or without a letter.
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)
BREAK = re.compile(rb"[\x00-@\[-`{-\x7f]")


def _blocks(text: bytes) -> Iterator[str]:
    """The text in pieces that end at an ASCII sign, so no run is cut."""
    begin = 0
    while begin < len(text):
        found = BREAK.search(text, begin + BLOCK) if begin + BLOCK < len(text) else None
        end = found.end() if found else len(text)
        yield text[begin:end].decode("utf-8", "replace")
        begin = end


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) as counted by this task so far."""
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        made = pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return made

    for b in batches:
        for doc, text in zip(column(b, "doc_id").to_pylist(), utf8(b, "text"), strict=True):
            runs: Counter[str] = Counter()
            for block in _blocks(text.lower() if text else b""):
                runs.update(RUN.findall(block))
            head = zlib.crc32(f"{doc}:".encode())
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), head)
                if h % DROP_EVERY == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < MIN_LENGTH:
                        continue
                counts[run] += n
            if len(counts) >= HELD:
                yield out()
    yield out()


def words(docs: DataFrame) -> DataFrame:
    """(word, n): words of MIN_LENGTH code points or more with MIN_COUNT occurrences or more in all texts."""
    text = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return text.mapInArrow(_occurrences, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _split(rows: DataFrame) -> DataFrame:
    """Each row once for either half that the edit may have left whole.

    ``rest`` is the part of the word that the key does not hold yet; ``longer`` is 1 for the grams
    of a word one letter longer than its partners.  Head: position 0.  Tail: counted from the end, so shifted by ``longer``."""
    length = F.length("rest") - F.col("longer")
    half = (length / 2).cast("int")
    rest = F.col("rest")
    keyed = lambda part, chunk: F.xxhash64("key", length, F.lit(part), chunk)
    head, tail = rest.substr(F.lit(1), half), rest.substr(half + F.col("longer") + 1, F.length("rest"))
    kept = F.array(F.struct(keyed(0, head).alias("key"), rest.substr(half + 1, F.length("rest")).alias("rest")),
                   F.struct(keyed(1, tail).alias("key"), rest.substr(F.lit(1), half + F.col("longer")).alias("rest")))
    return rows.select("word", "n", "gram", "longer", F.explode(kept).alias("k")).select("word", "n", "gram", "longer", "k.key", "k.rest")


def _sides(vocabulary: DataFrame) -> DataFrame:
    """Rows of the chunk side, and of the gram side against partners of the same length and one letter shorter."""
    side = F.explode(F.array(*(F.struct(F.lit(g).alias("gram"), F.lit(d).alias("longer")) for g, d in ((False, 0), (True, 0), (True, 1)))))
    return vocabulary.select("word", "n", side.alias("s")).select("word", "n", "s.gram", "s.longer", F.lit(0).cast("long").alias("key"), F.col("word").alias("rest"))


def _dense() -> Column:
    """Buckets whose rows meet more than PAIRS partners on average, and still have letters to tell them apart by."""
    return (F.col("chunks") * F.col("grams") > PAIRS * (F.col("chunks") + F.col("grams"))) & (F.col("left_over") >= 2)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words at edit distance one, once."""
    ensure_checkpoint_dir(vocabulary.sparkSession)
    rows, found = _split(_sides(vocabulary)), None
    while True:
        size = rows.groupBy("key").agg(F.count_if(~F.col("gram")).alias("chunks"), F.count_if("gram").alias("grams"),
                                       F.min(F.length("rest") - F.col("longer")).alias("left_over")).filter("chunks > 0 and grams > 0")
        rows = rows.join(size, "key").withColumn("dense", _dense()).drop("chunks", "grams", "left_over").checkpoint()
        sparse = rows.filter("not dense")
        a, b = sparse.filter("not gram").alias("a"), sparse.filter("gram").alias("b")
        near = (F.col("a.key") == F.col("b.key")) & ((F.col("b.longer") == 1) | (F.col("a.word") < F.col("b.word"))) & (
            F.length("a.word") + F.col("b.longer") == F.length("b.word")) & (F.levenshtein("a.word", "b.word", 1) == 1)
        pairs = a.join(b, near).select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n"))
        found = pairs if found is None else found.union(pairs)
        dense = rows.filter("dense")
        if not dense.head(1):
            return found.distinct()
        rows = _split(dense)


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of words with a form: pointers are doubled until none moves."""
    at = links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")).checkpoint()
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        if not at.filter("moved").head(1):
            return at.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    ensure_checkpoint_dir(docs.sparkSession)
    vocabulary = words(docs).checkpoint()
    pairs = near_pairs(vocabulary)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("word")).alias("near")),
                                          F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("word")).alias("near")))).alias("p"))
    best = both.groupBy(F.col("p.word").alias("word")).agg(F.count("*").alias("n_near"), F.min("p.near").alias("best"))
    takes = -F.col("best.less") >= RATIO * F.col("n")
    known = (vocabulary.join(best, "word", "left")
             .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.word")).alias("form"),
                     F.when(takes, -F.col("best.less")).alias("form_n"))).checkpoint()
    return (known.join(_roots(known.filter("form is not null")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
