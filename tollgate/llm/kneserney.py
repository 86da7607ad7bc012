"""Interpolated modified Kneser-Ney bigram model, counted in Spark, stored as sorted
hash arrays that scoring tasks map into memory.

Counting.  A task reduces its tokens to distinct (context, word) pairs with counts and
deals them out by the context's hash as sorted arrays; so a row of the shuffle is one task's
sorted run for one shard, and a very common pair is one entry of each run.  Contexts that
make up more than 1 / ``HOT_PARTS`` of all tokens (at most ``HOT_PARTS`` of them, a bounded list) are
split further by the word.  A shard merges its runs, and writes

* pairs-*.key / .count: sorted 64-bit hashes of (context, word), and their counts,

and passes on, again as sorted runs by the word's hash, each word's part in what follows: how often it
stands as context with 1, 2, 3 or more different counts, and how many different contexts it follows.  A second
shuffle merges these to

* words-*.key / .count / .stat: sorted word hashes, their counts, N1 N2 N3+ as context and
  the number of different contexts before them.

Only the counts of counts and sums reach the driver (a few numbers per shard).  Discounts are
D_k = k - (k + 1) * Y * n_(k+1) / n_k with Y = n_1 / (n_1 + 2 n_2), for both orders; where a count of counts
is 0 the discount is clipped to 0..k.  With c(h) the occurrences of h before a token,

    p(w | h) = max(c(h, w) - D(c), 0) / c(h) + gamma(h) * p1(w),
    p1(w)    = max(n(. w) - D1(n), 0) / n(. .) + gamma1 / (V + 1);

an unseen h gives p1 alone; V + 1 counts one word for all that was not seen.

Scoring is one pass over the texts: each batch looks its sorted distinct hashes up in the mapped
shards by binary search.  A text's score is the sum over its words and one end token; the first word's
context is a start token that is never predicted.

The model holds order 2: see the README for what order 3 takes on disk.

Defined results: null and empty text is the end token alone; with nothing to learn from, N = V = 0, the base score
is log10(1) and the model gives 0 for every token; a null doc_id is not held out; repeated rows count as often
as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import GOLDEN, SharedFolder, WordHashes, chunked, column, held_out, lower_words, mix64, utf8
from tollgate.session import ensure_checkpoint_dir

START, END = np.uint64(1), np.uint64(2)
HOT_PARTS = 256
#: Distinct pairs a task holds before it deals them out.
FLUSH = 3_000_000
#: Tokens of a shard, for the number of shards.
SHARD_TOKENS = 2_000_000
MOD = 5


def pair_key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(h * GOLDEN + w)


def narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the narrowest width that holds them; a file's size tells its width."""
    top = int(values.max()) if values.size else 0
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of equal neighbours."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return first, np.diff(np.append(first, len(keys)))


def _pair_runs(h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts pairs; first index, length, and the order."""
    order = np.lexsort((w, h))
    hs, ws = h[order], w[order]
    if not len(h):
        return order, np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], (hs[1:] != hs[:-1]) | (ws[1:] != ws[:-1]))))
    return order, first, np.diff(np.append(first, len(h)))


class Sharding:
    """Shard of a pair: by its context, and by its word too if the context is hot."""

    def __init__(self, shards: int, hot: list[int]):
        self.shards, self.hot = shards, np.array(sorted(hot), dtype=np.uint64)

    def word(self, w: np.ndarray) -> np.ndarray:
        return ((w >> np.uint64(32)) * np.uint64(self.shards)) >> np.uint64(32)

    def pair(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        by = h
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
            by = np.where(self.hot[at] == h, pair_key(h, w), h)
        return self.word(by)


#: Discounts are no smaller, whatever the counts of counts.
LEAST_DISCOUNT = 0.1


@dataclass
class Model:
    """What the driver knows of a model; the arrays are in the folder."""

    folder: SharedFolder
    sharding: Sharding
    tokens: int = 0
    vocabulary: int = 0
    discounts: tuple[float, ...] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, ...] = (0.0, 0.0, 0.0)
    types: int = 0
    start_count: int = 0
    start_types: tuple[int, ...] = (0, 0, 0)
    word_types: tuple[int, ...] = field(default=(0, 0, 0))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more.

    Where a count of counts is 0 the formula may give none; the least one leaves every lower order a share, so
    scores stay finite and probabilities still sum to one (the share is what the discounts take)."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [k - (k + 1) * y * up / n if n else 0.0 for k, n, up in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, LEAST_DISCOUNT), float(k)) for k, d in enumerate(raw, 1))


def _text_pairs(text: bytes | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    words = hashes.of(lower_words(text))
    return np.concatenate(([START], words)), np.concatenate((words, [END]))


def _hot_words(docs: DataFrame) -> tuple[int, list[int]]:
    """All tokens, and the hashes of words above 1 / HOT_PARTS of them; a word above that share overall is so in some task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total, some = WordHashes(), 0, {}
        for b in chunked(batches, 2048):
            parts = [hashes.of(lower_words(t)) for t in utf8(b, "text")]
            if not parts:
                continue
            words = np.concatenate(parts)
            total += len(words) + len(parts)
            values, n = np.unique(words, return_counts=True)
            for v, k in zip(values.tolist(), n.tolist(), strict=True):
                if k > len(words) / (4 * HOT_PARTS):
                    some[v] = some.get(v, 0) + k
        found = [(v, n) for v, n in some.items() if n > total / (2 * HOT_PARTS)]
        yield pa.record_batch([pa.array([0] + [v - (1 << 64) if v >> 63 else v for v, _ in found], pa.int64()),
                               pa.array([total] + [n for _, n in found], pa.int64())], names=["w", "n"])

    sums = docs.select("text").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).checkpoint()
    total = (sums.filter("w = 0").first() or [0, 0])[1]
    hot = sums.filter(F.col("w") != 0).filter(F.col("n") > total / (2 * HOT_PARTS)).collect()
    return total, [r["w"] % (1 << 64) for r in hot]


def _deal(h: np.ndarray, w: np.ndarray, sharding: Sharding) -> Iterator[tuple[int, bytes]]:
    """Sorted distinct pairs with counts of each shard, as one byte string: sizes, contexts, their numbers of words, words, counts."""
    order, first, n = _pair_runs(h, w)
    h, w = h[order][first], w[order][first]
    shard = sharding.pair(h, w)
    by = np.argsort(shard, kind="stable")
    h, w, n, shard = h[by], w[by], n[by].astype(np.uint32), shard[by]
    at, length = _runs(shard)
    for i, k in zip(at.tolist(), length.tolist(), strict=True):
        ch, cn = _runs(h[i:i + k])
        counts = n[i:i + k]
        small = counts.astype(np.uint8) if counts.max() < 256 else counts
        head = np.array([len(ch), k, small.itemsize], dtype=np.uint64)
        yield int(shard[i]), b"".join(x.tobytes() for x in (head, h[i:i + k][ch], cn.astype(np.uint32), w[i:i + k], small))


def _undeal(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    contexts, k, width = np.frombuffer(run, np.uint64, 3).tolist()
    at = 24
    h = np.frombuffer(run, np.uint64, contexts, at)
    at += 8 * contexts
    cn = np.frombuffer(run, np.uint32, contexts, at)
    at += 4 * contexts
    w = np.frombuffer(run, np.uint64, k, at)
    at += 8 * k
    return np.repeat(h, cn), w, np.frombuffer(run, np.uint8 if width == 1 else np.uint32, k, at).astype(np.uint32)


def _pair_rows(sharding: Sharding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for shard, data in _deal(np.concatenate([h for h, _ in held]), np.concatenate([w for _, w in held]), sharding):
                yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([data], pa.binary())], names=["shard", "run"])
            held.clear()

        for b in batches:
            for t in utf8(b, "text"):
                held.append(_text_pairs(t, hashes))
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return run


def _merge_pairs(folder: SharedFolder, sharding: Sharding):
    """Writes a shard's pairs; passes on each word's statistics as runs by the word's shard."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_undeal(r) for r in rows.pop("run")]
        h, w, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order, first, _ = _pair_runs(h, w)
        h, w, n = h[order][first], w[order][first], np.add.reduceat(n[order].astype(np.uint64), first)
        keys = pair_key(h, w)
        by = np.argsort(keys)
        folder.write(f"pairs-{key[0]:06d}.key", keys[by].tobytes())
        folder.write(f"pairs-{key[0]:06d}.count", narrow(n[by]).tobytes())
        of = [int(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)]
        at, _ = _runs(h)
        stats = [np.add.reduceat(x.astype(np.uint64), at) for x in (n, n == 1, n == 2, n >= 3)]
        words, follows = np.unique(w, return_counts=True)
        out = [(int(s), a, None) for s, a in _split(h[at], np.stack(stats, axis=1), sharding)]
        out += [(int(s), None, a) for s, a in _split(words, follows[:, None].astype(np.uint64), sharding)]
        sums = np.array([*of, len(h)], dtype=np.uint64).tobytes()
        return pd.DataFrame({"shard": [s for s, _, _ in out] + [-1], "as_context": [a for _, a, _ in out] + [sums], "as_word": [a for _, _, a in out] + [None]})

    return run


def _split(keys: np.ndarray, values: np.ndarray, sharding: Sharding) -> Iterator[tuple[int, bytes]]:
    """Rows of sorted word hashes with their values, by shard (sorted keys have sorted shards)."""
    at, length = _runs(sharding.word(keys))
    for i, k in zip(at.tolist(), length.tolist(), strict=True):
        v = values[i:i + k]
        small = v.astype(np.uint8) if v.max() < 256 else v.astype(np.uint32) if v.max() < 1 << 32 else v
        yield int(sharding.word(keys[i:i + 1])[0]), np.array([k, small.itemsize], np.uint64).tobytes() + keys[i:i + k].tobytes() + small.tobytes()


def _unsplit(run: bytes, columns: int) -> tuple[np.ndarray, np.ndarray]:
    k, width = np.frombuffer(run, np.uint64, 2).tolist()
    kind = {1: np.uint8, 4: np.uint32, 8: np.uint64}[width]
    return np.frombuffer(run, np.uint64, k, 16), np.frombuffer(run, kind, k * columns, 16 + 8 * k).reshape(k, columns).astype(np.uint64)


def _merge_words(folder: SharedFolder):
    """Writes a shard of words: count as context, N1 N2 N3+ as context, number of contexts before; returns the sums."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        context = [_unsplit(r, 4) for r in rows["as_context"] if r is not None]
        word = [_unsplit(r, 1) for r in rows["as_word"] if r is not None]
        keys = np.concatenate([k for k, _ in context + word])
        values = np.concatenate([np.concatenate([v, np.zeros((len(v), 1), np.uint64)], axis=1) for _, v in context]
                                + [np.concatenate([np.zeros((len(v), 4), np.uint64), v], axis=1) for _, v in word])
        order = np.argsort(keys, kind="stable")
        at, _ = _runs(keys[order])
        keys, values = keys[order][at], np.add.reduceat(values[order], at, axis=0)
        start = values[keys == START]
        values, keys = values[keys != START], keys[keys != START]
        folder.write(f"words-{key[0]:06d}.key", keys.tobytes())
        folder.write(f"words-{key[0]:06d}.stat", narrow(values).tobytes())
        n = values[:, 4]
        sums = [len(keys), int(values[:, 0].sum()), int(n.sum()), *[int(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)],
                int(np.count_nonzero(n >= 3)), *(start[0, :4].tolist() if len(start) else [0] * 4)]
        return pd.DataFrame({"sums": [np.array(sums, dtype=np.uint64).tobytes()]})

    return run


def train(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Counts ``docs`` (text) and writes the model below spark.checkpoint.dir."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = SharedFolder.new(spark, "kneserney")
    tokens, hot = _hot_words(docs)
    model = Model(folder, Sharding(max(1, -(-tokens // shard_tokens)), hot), tokens)
    shards = model.sharding.shards
    pairs = docs.select("text").mapInArrow(_pair_rows(model.sharding), "shard int, run binary")
    stats = (pairs.repartition(shards, "shard").groupBy("shard")
             .applyInPandas(_merge_pairs(folder, model.sharding), "shard int, as_context binary, as_word binary")).checkpoint()
    of = [np.frombuffer(r["as_context"], np.uint64) for r in stats.filter("shard = -1").select("as_context").collect()]
    words = (stats.filter("shard >= 0").repartition(shards, "shard").groupBy("shard").applyInPandas(_merge_words(folder), "sums binary")).checkpoint()
    sums = [np.frombuffer(r["sums"], np.uint64) for r in words.collect()]
    if not of:
        return model
    n = np.sum(of, axis=0).tolist()
    s = np.sum(sums, axis=0).tolist()
    model.discounts, model.types = discounts(*n[:4]), s[2]
    model.vocabulary = s[0]
    model.word_discounts, model.word_types = discounts(*s[3:7]), (s[3], s[4], s[7])
    model.start_count, model.start_types = s[8], tuple(s[9:12])
    return model


class Scorer:
    """A task's view of the model: shards are mapped when first asked for."""

    def __init__(self, model: Model):
        self.m, self.files = model, {}
        d, t = model.word_discounts, model.word_types
        self.rest = sum(x * y for x, y in zip(d, t, strict=True)) / model.types / (model.vocabulary + 1) if model.types else 1.0

    def _file(self, name: str, dtype) -> np.ndarray:
        if name not in self.files:
            self.files[name] = self.m.folder.map(name, dtype)
        return self.files[name]

    def _find(self, kind: str, shard: np.ndarray, keys: np.ndarray, value: str, columns: int) -> np.ndarray:
        """Values of sorted-by-shard keys; 0 where a key is not in the model."""
        out = np.zeros((len(keys), columns), dtype=np.uint64)
        at, length = _runs(shard)
        for i, k in zip(at.tolist(), length.tolist(), strict=True):
            name = f"{kind}-{int(shard[i]):06d}"
            known = self._file(f"{name}.key", np.uint64)
            if not len(known):
                continue
            asked = keys[i:i + k]
            place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[place] == asked
            raw = self._file(f"{name}.{value}", np.uint8)
            values = raw.view(f"u{len(raw) // (len(known) * columns)}").reshape(-1, columns)
            out[i:i + k][hit] = values[place[hit]]
        return out

    def word_stats(self, words: np.ndarray) -> np.ndarray:
        """(c as context, N1, N2, N3+, n contexts before) of sorted distinct words."""
        out = self._find("words", self.m.sharding.word(words), words, "stat", 5)
        out[words == START, :4] = (self.m.start_count, *self.m.start_types)
        return out

    def pair_counts(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        shard, keys = self.m.sharding.pair(h, w), pair_key(h, w)
        order = np.lexsort((keys, shard))
        out = np.zeros(len(h), dtype=np.uint64)
        out[order] = self._find("pairs", shard[order], keys[order], "count", 1)[:, 0]
        return out

    @staticmethod
    def _discount(n: np.ndarray, d: tuple[float, ...]) -> np.ndarray:
        return np.array((0.0, *d))[np.minimum(n, 3).astype(np.int64)]

    def score(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 of the base share, known, log10 p) of tokens w after contexts h."""
        m = self.m
        if not m.tokens:
            return np.zeros(len(w)), np.zeros(len(w), bool), np.zeros(len(w))
        words, inverse = np.unique(np.concatenate((h, w)), return_inverse=True)
        stats = self.word_stats(words)
        before, own = stats[inverse[:len(h)]], stats[inverse[len(h):]]
        # A word is a context each time it occurs; the end token occurs once per text, as the start token does.
        count = np.where(w == END, m.start_count, own[:, 0])
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))
        n = own[:, 4]
        p = np.maximum(n - self._discount(n, m.word_discounts), 0) / m.types + self.rest
        c = before[:, 0].astype(np.float64)
        seen = c > 0
        joint = self.pair_counts(h, w)
        total = np.where(seen, c, 1.0)
        gamma = np.where(seen, before[:, 1:4].astype(np.float64) @ np.array(m.discounts) / total, 1.0)
        p = np.where(seen, np.maximum(joint - self._discount(joint, m.discounts), 0) / total, 0.0) + gamma * p
        return base, count > 0, np.log10(p)


def score(docs: DataFrame, model: Model, modulus: int = MOD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, scorer = WordHashes(), Scorer(model)
        for b in chunked(batches, 1024):
            pairs = [_text_pairs(t, hashes) for t in utf8(b, "text")]
            if not pairs:
                continue
            length = np.array([len(h) for h, _ in pairs])
            base, known, p = scorer.score(np.concatenate([h for h, _ in pairs]), np.concatenate([w for _, w in pairs]))
            at = np.concatenate(([0], np.cumsum(length)[:-1]))
            own = np.add.reduceat(p, at)
            yield pa.record_batch([column(b, "doc_id"), pa.array(length, pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), at), pa.int64()),
                                   pa.array([model.tokens] * len(length), pa.int64()), pa.array(np.add.reduceat(base, at)), pa.array(own),
                                   pa.array(10.0 ** np.minimum(-own / length, 300.0))],
                                  names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    return out.withColumn("held_out", held_out(F.col("doc_id"), modulus))


def score_held_out(docs: DataFrame, modulus: int = MOD) -> DataFrame:
    """Learns from the rows that are not held out, scores all."""
    return score(docs, train(docs.filter(~held_out(F.col("doc_id").cast("long"), modulus))), modulus)
