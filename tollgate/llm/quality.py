"""Quality rules: repetition and length rules, and Jensen-Shannon distances to
language references.

A document is judged by two histograms against the references of its language:

* character classes (lower case, upper case, digits, blanks, full stops and
  commas, other ASCII symbols, other characters);
* common words: the words that make up at least ``COMMON_SHARE`` of a language's
  words, and one class for all others.

References are sums over all documents of a language that pass the base rules.  A language has a
character reference from ``REF_DOCS`` documents, and a word reference if these have ``REF_WORDS`` words and
some of them are common; without one its documents are not judged by that rule.  The
distance is the square root of the Jensen-Shannon divergence in bits, 0 to 1.
A document fails if a distance exceeds its limit, or if its language's common words are too few in it: under
``MIN_COMMON`` of their number in as many words of the reference, and fewer by ``SURE`` standard deviations or more
(word salad, lists of names, another language).  Guards: the character histogram
counts only from ``MIN_CHARS`` characters, the word histogram from ``MIN_WORDS`` words.
A null language is judged by its nearest reference of the ``HELD_LANGS`` largest languages, but never for a lack of
common words.

Defined results: null or blank text has no words and fails the base rules; with no
references (an empty or all-failing table) only the base rules judge; a null doc_id
is passed through; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import BROADCAST_ROWS, WordHashes, column, ngram_hashes, utf8
from tollgate.session import ensure_checkpoint_dir

MIN_BASE_WORDS, MAX_REPEAT = 20, 30
MIN_CHARS, MIN_WORDS = 200, 50
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.48
MIN_COMMON, SURE = 0.5, 3.5
COMMON_SHARE = 0.002
REF_DOCS, REF_WORDS = 20, 5000
#: References of so many languages, the largest, are held by every task; those of all others are joined to their documents.
HELD_LANGS = 1000
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
N_CLASSES = 7
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]

_ASCII_CLASS = np.full(128, 5, dtype=np.int64)
_ASCII_CLASS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 0
_ASCII_CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_ASCII_CLASS[[ord(c) for c in "0123456789"]] = 2
_ASCII_CLASS[[ord(c) for c in BLANKS]] = 3
_ASCII_CLASS[[ord(c) for c in ".,"]] = 4


def char_classes(text: str) -> np.ndarray:
    """Counts of the seven classes; letters beyond ASCII count by their case."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ascii_ = points < 128
    out = np.bincount(_ASCII_CLASS[points[ascii_]], minlength=N_CLASSES)
    if not ascii_.all():
        values, counts = np.unique(points[~ascii_], return_counts=True)
        for v, n in zip(values.tolist(), counts.tolist(), strict=True):
            c = chr(v)
            out[0 if c.islower() else 1 if c.isupper() else 0 if c.isalpha() else 6] += n
    return out


def repeated_words(words: list[bytes], hashes: WordHashes) -> int:
    """Words inside 8-word windows that occur twice or more, first ones included."""
    grams = ngram_hashes(hashes.of(words), 8)
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[:len(grams)] += twice
    cover[8:8 + len(grams)] -= twice
    return int(np.count_nonzero(np.cumsum(cover)))


def base_counts(text: str, words: list[bytes], hashes: WordHashes) -> tuple[int, int, int, int]:
    """(word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words, hashes))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_BASE_WORDS or 100 * n_repeat_words > MAX_REPEAT * n_words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per language over documents that pass the base rules: word counts (word set), class counts (place set) and,
    as the place after these, documents."""
    hashes = WordHashes()
    words: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, c in words.items():
            yield pa.record_batch([pa.array([lang] * len(c)), pa.array([w.decode("utf-8", "replace") for w in c], pa.string()),
                                   pa.nulls(len(c), pa.int32()), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "place", "n"])
        words.clear()

    for b in batches:
        for lang, raw in zip(column(b, "lang").to_pylist(), utf8(b, "text"), strict=True):
            own = raw.split() if raw and lang is not None else []
            if len(own) < MIN_BASE_WORDS:
                continue
            text = raw.decode("utf-8", "replace")
            if base_failed(len(own), repeated_words(own, hashes)):
                continue
            words.setdefault(lang, Counter()).update(raw.lower().split())
            classes[lang] = classes.get(lang, 0) + np.append(char_classes(text), 1)
        if sum(map(len, words.values())) > 500_000:
            yield from flush()
    yield from flush()
    for lang, c in classes.items():
        yield pa.record_batch([pa.array([lang] * (N_CLASSES + 1)), pa.nulls(N_CLASSES + 1, pa.string()), pa.array(range(N_CLASSES + 1), pa.int32()),
                               pa.array(c.tolist(), pa.int64())], names=["lang", "word", "place", "n"])


class References:
    """Per language: character-class shares, common words (word -> place) and their shares."""

    def __init__(self, classes: dict[str, list[int]], words: dict[str, list[tuple[str, int, int]]]):
        self.lang = sorted(classes)
        share = lambda x: np.asarray(x, dtype=np.float64) / max(1, sum(x))
        self.classes = {k: share(classes[k]) for k in self.lang}
        self.places, self.words = {}, {}
        for k in self.lang:
            if not words.get(k):
                continue
            own = sorted(words[k])
            self.places[k] = {w.encode(): i for i, (w, _, _) in enumerate(own)}
            total = own[0][2]
            self.words[k] = share([n for _, n, _ in own] + [total - sum(n for _, n, _ in own)])


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    m = (p + q) / 2
    kl = lambda a: float(np.sum(a[a > 0] * np.log2(a[a > 0] / m[a > 0])))
    return float(np.sqrt(max(0.0, (kl(p) + kl(q)) / 2)))


def _distances(refs: References, lang: str | None, classes: np.ndarray, words: list[bytes]) -> tuple[float | None, float | None, bool]:
    """(character distance, word distance, whether these fail) to the language's reference, for a null language to the nearest;
    None where a guard holds or there is no reference."""
    langs = refs.lang if lang is None else [lang] if lang in refs.classes else []
    total, n = int(classes.sum()), len(words)
    by_char = by_word = None
    failed = False
    if total >= MIN_CHARS and langs:
        by_char = min(js_distance(classes / total, refs.classes[k]) for k in langs)
        failed = by_char > MAX_CHAR_DISTANCE
    langs = [k for k in langs if k in refs.words]
    if n >= MIN_WORDS and langs:
        own = Counter(words)
        def one(k: str) -> tuple[float, str]:
            h = np.zeros(len(refs.words[k]))
            for w, i in refs.places[k].items():
                h[i] = own.get(w, 0)
            h[-1] = n - h.sum()
            return js_distance(h / n, refs.words[k]), k
        by_word, near = min(map(one, langs))
        if lang is None:
            failed |= by_word > max(MAX_WORD_DISTANCE, _without_common(refs.words[near]))
        else:
            failed |= by_word > MAX_WORD_DISTANCE or _lacks_common(sum(own.get(w, 0) for w in refs.places[near]), n, refs.words[near])
    return by_char, by_word, failed


def _without_common(reference: np.ndarray) -> float:
    """Word distance of a text without any common word, and a little more."""
    return js_distance(np.eye(len(reference))[-1], reference) + 1e-9


def _lacks_common(found: int, n: int, reference: np.ndarray) -> bool:
    rest = float(reference[-1])
    expected = n * (1 - rest)
    return found < min(MIN_COMMON * expected, expected - SURE * (expected * rest) ** 0.5)


def references(docs: DataFrame, held: int = HELD_LANGS) -> tuple[References, DataFrame | None]:
    """From all documents that pass the base rules and have a language.

    Words are counted in full; only those at COMMON_SHARE of their language, at most
    500 each, of the ``held`` largest languages reach the driver.  If there are more, (r_lang, _reference) of the others."""
    sums = (docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(_count, "lang string, word string, place int, n long")
            .groupBy("lang", "word", "place").agg(F.sum("n").alias("n"))).checkpoint()
    sizes = sums.groupBy("lang").agg(F.sum(F.when(F.col("word").isNotNull(), F.col("n"))).alias("total"), F.max(F.when(F.col("place") == N_CLASSES, F.col("n"))).alias("docs"))
    sizes = sizes.filter(F.col("docs") >= REF_DOCS).checkpoint()
    largest = sizes.orderBy(F.desc("total"), "lang").limit(held + 1).collect()
    large = sizes.filter(F.col("lang").isin([r["lang"] for r in largest[:held]])) if len(largest) > held else sizes
    used = F.when(F.col("word").isNull(), F.col("place") < N_CLASSES).otherwise((F.col("total") >= REF_WORDS) & (F.col("n") >= COMMON_SHARE * F.col("total")))
    classes: dict[str, list[int]] = {}
    words: dict[str, list[tuple[str, int, int]]] = {}
    for r in sums.join(F.broadcast(large), "lang").filter(used).collect():
        if r["word"] is None:
            classes.setdefault(r["lang"], [0] * N_CLASSES)[r["place"]] = r["n"]
        else:
            words.setdefault(r["lang"], []).append((r["word"], r["n"], r["total"]))
    more = None
    if len(largest) > held:
        rows = sums.join(sizes.join(F.broadcast(large.select("lang")), "lang", "left_anti"), "lang").filter(used)
        more = rows.groupBy(F.col("lang").alias("r_lang")).agg(F.to_json(F.collect_list(F.struct("word", "place", "n", "total"))).alias("_reference"), F.count("*").alias("size")).checkpoint()
        more = F.broadcast(more) if more.agg(F.sum("size")).first()[0] <= BROADCAST_ROWS else more.hint("merge")
    return References(classes, words), more


def _referred(docs: DataFrame, refs: References, more: DataFrame | None) -> DataFrame:
    """The documents; with _reference for those of languages that ``refs`` does not hold, if there are more."""
    if more is None:
        return docs
    held = F.coalesce(F.col("lang").cast("string").isin(refs.lang), F.lit(True))
    rest = docs.filter(~held).withColumn("r_lang", F.col("lang").cast("string")).join(more, "r_lang", "left")
    return docs.filter(held).withColumn("_reference", F.lit(None).cast("string")).union(rest.select(*docs.columns, "_reference"))


def _read(lang: str, reference: str) -> References:
    rows = json.loads(reference)
    classes = [0] * N_CLASSES
    for r in rows:
        if "place" in r:
            classes[r["place"]] = r["n"]
    return References({lang: classes}, {lang: [(r["word"], r["n"], r["total"]) for r in rows if "word" in r]})


def _judge(refs: References, b: pa.RecordBatch, hashes: WordHashes, joined: dict[str, References]) -> list[tuple]:
    """``joined``: references read from the documents so far, kept per task."""
    rows = []
    own = column(b, "_reference").to_pylist() if "_reference" in b.schema.names else [None] * b.num_rows
    for lang, raw, reference in zip(column(b, "lang").to_pylist(), utf8(b, "text"), own, strict=True):
        lang = None if lang is None else str(lang)
        text = raw.decode("utf-8", "replace") if raw else ""
        words = raw.split() if raw else []
        counts = base_counts(text, words, hashes)
        failed = base_failed(len(words), counts[3])
        if reference is not None and lang not in joined:
            if len(joined) >= HELD_LANGS:
                joined.clear()
            joined[lang] = _read(lang, reference)
        chars, common, far = _distances(refs if reference is None else joined[lang], lang, char_classes(text), raw.lower().split() if raw else [])
        rows.append((len(words), *counts, failed, chars, common, not (failed or far)))
    return rows


def quality_rules(docs: DataFrame, held: int = HELD_LANGS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance (null under a guard or without a reference), kept."""
    ensure_checkpoint_dir(docs.sparkSession)
    refs, more = references(docs, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, joined = WordHashes(), {}
        for b in batches:
            cols = list(zip(*_judge(refs, b, hashes, joined), strict=True)) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.record_batch([column(b, "doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", *NAMES])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    return _referred(rows, refs, more).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, char_distance double, word_distance double, kept boolean")


def kept_documents(docs: DataFrame, held: int = HELD_LANGS) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    ensure_checkpoint_dir(docs.sparkSession)
    refs, more = references(docs, held)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, joined = WordHashes(), {}
        for b in batches:
            yield b.filter(pa.array([r[-1] for r in _judge(refs, b, hashes, joined)], pa.bool_())).select(columns)

    return _referred(docs, refs, more).mapInArrow(run, docs.schema)
