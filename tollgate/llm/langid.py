"""Language identification with string kernels.

The kernel of two texts is the blended-spectrum presence kernel: the number of distinct
character n-grams (n = 1 to 3) they share, over the root of the product of their own numbers.  Nystroem
landmarks stand for the whole kernel matrix: with K_nm between training texts and landmarks
and K_mm between landmarks, one-versus-rest ridge regression solves

    (K_nm' K_nm + ridge * K_mm) a = K_nm' Y.

A text's scores are k(text, landmarks) a.  Since the kernel is an inner product of presence
vectors, the landmarks' n-grams and ``a`` fold into one weight matrix (n-grams x languages), and a
batch of texts is scored by one matrix product of its presence rows with it.

Only a bounded sample is learned from: per language the ``TRAIN_PER_LANG`` labelled rows of the smallest
id hash, of them ``LANDMARKS_PER_LANG`` landmarks; at most ``MAX_LANGS`` languages, those with most rows.
Held-out rows, null labels and texts without a letter are not learned from.

Texts are lower-cased, and digits, signs and white space count as one blank; characters that no landmark
has are one unknown character.

Defined results: null text or text without a letter is ``und`` with score 0; without any training row
every text is ``und``; a null doc_id is not held out and is passed through; repeated rows are scored
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import chunked, column, held_out

TRAIN_PER_LANG, LANDMARKS_PER_LANG, MAX_LANGS = 300, 48, 64
#: Times TRAIN_PER_LANG rows of a language are expected below its hash bound; fewer than one time them has no
#: noticeable chance, unless its rows share few ids.
CHOICE = 4
RIDGE = 1.0
UNKNOWN_LANG = "und"


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points; runs without letters become one blank, at both ends too."""
    p = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ascii_ = p < 128
    letter = np.where(ascii_, (p >= 97) & (p <= 122), True)
    if not ascii_.all():
        values, inverse = np.unique(p[~ascii_], return_inverse=True)
        letter[~ascii_] = np.array([chr(v).isalpha() for v in values.tolist()])[inverse]
    q = np.concatenate(([32], np.where(letter, p, 32), [32]))
    keep = np.ones(len(q), dtype=bool)
    keep[1:] = (q[1:] != 32) | (q[:-1] != 32)
    return q[keep]


class Alphabet:
    """Character -> small number (0: unknown, 1: blank), and the codes of n-grams below size**3 * 3."""

    def __init__(self, chars: list[int]):
        self.chars = np.array(sorted(c for c in chars if c != 32), dtype=np.uint32)
        self.size = len(self.chars) + 2

    def numbers(self, points: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.chars, points)
        at = np.minimum(at, max(0, len(self.chars) - 1))
        known = self.chars[at] == points if len(self.chars) else np.zeros(len(points), bool)
        return np.where(points == 32, 1, np.where(known, at + 2, 0)).astype(np.int64)

    def grams(self, points: np.ndarray) -> np.ndarray:
        """Distinct codes of the 1-, 2- and 3-grams, sorted."""
        s, x = self.size, self.numbers(points)
        two = x[:-1] * s + x[1:]
        three = two[:-1] * s + x[2:]
        return np.unique(np.concatenate([x, two + s, three + s + s * s]))


class KernelModel:
    """langs, n-gram codes (sorted) and the folded weights (n-grams x languages)."""

    def __init__(self, langs: list[str], alphabet: Alphabet, codes: np.ndarray, weights: np.ndarray):
        self.langs, self.alphabet, self.codes, self.weights = langs, alphabet, codes, weights

    @classmethod
    def fit(cls, texts: list[str], labels: list[str], landmark: list[bool], ridge: float = RIDGE) -> KernelModel:
        langs = sorted(set(labels))
        points = [code_points(t) for t in texts]
        alphabet = Alphabet(np.unique(np.concatenate([p for p, m in zip(points, landmark, strict=True) if m])).tolist())
        grams = [alphabet.grams(p) for p in points]
        marks = [g for g, m in zip(grams, landmark, strict=True) if m]
        codes = np.unique(np.concatenate(marks))
        presence = lambda gs: np.stack([np.isin(codes, g, assume_unique=True) for g in gs]).astype(np.float32)
        scaled = presence(marks) / np.sqrt([[len(g)] for g in marks])
        k_nm = np.concatenate([presence(grams[i:i + 256]) @ scaled.T / np.sqrt([[len(g)] for g in grams[i:i + 256]]) for i in range(0, len(grams), 256)]).astype(np.float64)
        k_mm = k_nm[np.flatnonzero(landmark)]
        y = np.where(np.array(labels)[:, None] == np.array(langs)[None, :], 1.0, -1.0)
        m = k_nm.T @ k_nm + ridge * k_mm + 1e-6 * np.eye(len(marks))
        a = np.linalg.lstsq(m, k_nm.T @ y, rcond=None)[0]
        return cls(langs, alphabet, codes, (scaled.T.astype(np.float64) @ a).astype(np.float32))

    def scores(self, points: list[np.ndarray]) -> np.ndarray:
        rows = np.zeros((len(points), len(self.codes)), dtype=np.float32)
        for i, p in enumerate(points):
            g = self.alphabet.grams(p)
            at = np.minimum(np.searchsorted(self.codes, g), len(self.codes) - 1)
            rows[i, at[self.codes[at] == g]] = 1.0 / np.sqrt(len(g))
        return rows @ self.weights


def fit(docs: DataFrame) -> KernelModel | None:
    """Learns from the bounded sample of rows that are not held out."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
            .filter("lang is not null and doc_id is not null and text is not null").filter(~held_out(F.col("doc_id"), 3))
            .withColumn("h", F.xxhash64("doc_id", "text")))
    top = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("count")).orderBy(F.desc("count"), "lang").limit(MAX_LANGS)
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    # By the language's own count only so many hashes are low enough to be looked at: no task ranks a whole language.  Rows are
    # ranked by id and text, and repeated ones are one before that, so neither a hot id nor a hot text counts twice.
    share = F.least(F.lit(1.0), F.lit(float(CHOICE * TRAIN_PER_LANG)) / F.col("count"))
    sample = (rows.join(F.broadcast(top), "lang")
              .filter((share >= 1) | (F.col("h") / F.lit(2.0 ** 64) + 0.5 < share)).groupBy("lang", "h", "doc_id").agg(F.first("text").alias("text"))
              .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= TRAIN_PER_LANG))
    learned = sample.orderBy("lang", "place").collect()
    learned = [r for r in learned if r["text"] and any(c.isalpha() for c in r["text"])]
    if not learned:
        return None
    return KernelModel.fit([r["text"] for r in learned], [r["lang"] for r in learned], _landmarks([r["lang"] for r in learned]))


def _landmarks(labels: list[str]) -> list[bool]:
    seen: dict[str, int] = {}
    out = []
    for lang in labels:
        seen[lang] = seen.get(lang, 0) + 1
        out.append(seen[lang] <= LANDMARKS_PER_LANG)
    return out


def predict(docs: DataFrame, model: KernelModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score: half of one plus the best language's lead over the second, within 0 to 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 128):
            points = [code_points(t) if t else None for t in column(b, "text").to_pylist()]
            some = [i for i, p in enumerate(points) if model is not None and p is not None and (p != 32).any()]
            lang, score = [UNKNOWN_LANG] * b.num_rows, [0.0] * b.num_rows
            if some:
                s = model.scores([points[i] for i in some])
                best = np.argmax(s, axis=1)
                if s.shape[1] > 1:
                    two = np.sort(s, axis=1)[:, -2:]
                    lead = np.clip(0.5 + (two[:, 1] - two[:, 0]) / 4, 0, 1)
                else:
                    lead = np.clip((s[:, 0] + 1) / 2, 0, 1)
                for i, k, v in zip(some, best.tolist(), lead.tolist(), strict=True):
                    lang[i], score[i] = model.langs[k], v
            yield pa.record_batch([column(b, "doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), 3).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))
