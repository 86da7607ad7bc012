"""Helpers shared by the training-data operators."""

from __future__ import annotations

import json
import os
import posixpath
import re
import string
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import checkpoint_root

MASK64 = (1 << 64) - 1
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Rows up to which a side is broadcast after it has been counted; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def mix64(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser of an unsigned 64-bit array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of n word hashes (empty if there are fewer)."""
    m = len(words) - n + 1
    if m <= 0:
        return words[:0]
    h = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        h = mix64(h * GOLDEN + words[k:k + m])
    return h


class WordHashes(dict):
    """word bytes -> 64-bit hash, kept per task; forgotten when it holds too many words."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def lower_words(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of UTF-8 text after lower-casing A-Z only."""
    return text.lower().split() if text else []


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def semi_by_size(df: DataFrame, ids: DataFrame, on: str, limit: int = BROADCAST_ROWS, how: str = "left_semi") -> DataFrame:
    """Semi or anti join: the ids are counted, and broadcast only up to ``limit`` rows."""
    small = ids.count() <= limit
    return df.join(F.broadcast(ids) if small else ids.hint("merge"), on, how)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value worked out once: expressions inside of lambdas are not shared otherwise."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def held_out(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; the remainder 1 is held out (a null id is not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus) == 1, F.lit(False))


def chunked(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


class SharedFolder:
    """Flat files in a folder below spark.checkpoint.dir, written and read inside tasks.

    A plain or file: path is opened directly and memory-mapped in place.  Any
    other store goes through pyarrow's file systems; a file that is to be mapped is
    then copied to an unlinked temporary file of the task, so nothing stays behind.
    Files are written under another name and moved, so a lost task can be run again.
    """

    def __init__(self, path: str):
        self.path = path

    @classmethod
    def new(cls, spark: SparkSession, kind: str) -> SharedFolder:
        folder = cls(posixpath.join(checkpoint_root(spark), f"{kind}-{uuid.uuid4().hex}"))
        fs, local = folder._fs()
        if fs is None:
            os.makedirs(local, exist_ok=True)
        else:
            fs.create_dir(local, recursive=True)
        return folder

    def _fs(self):
        if self.path.startswith("file:"):
            return None, "/" + self.path.removeprefix("file:").lstrip("/")
        if "://" not in self.path:
            return None, self.path
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, name: str, data: bytes) -> None:
        fs, root = self._fs()
        final, part = posixpath.join(root, name), posixpath.join(root, f"{name}.{uuid.uuid4().hex}.tmp")
        if fs is None:
            with open(part, "wb") as f:
                f.write(data)
            os.replace(part, final)
        else:
            with fs.open_output_stream(part) as f:
                f.write(data)
            fs.move(part, final)

    def writer(self, name: str):
        """(stream, commit): commit() closes the stream and gives the file its name."""
        fs, root = self._fs()
        final, part = posixpath.join(root, name), posixpath.join(root, f"{name}.{uuid.uuid4().hex}.tmp")
        stream = open(part, "wb") if fs is None else fs.open_output_stream(part)

        def commit() -> None:
            stream.close()
            os.replace(part, final) if fs is None else fs.move(part, final)

        return stream, commit

    def read(self, name: str, offset: int, length: int) -> bytes:
        fs, root = self._fs()
        if fs is None:
            with open(posixpath.join(root, name), "rb") as f:
                f.seek(offset)
                return f.read(length)
        with fs.open_input_file(posixpath.join(root, name)) as f:
            return f.read_at(length, offset)

    def map(self, name: str, dtype) -> np.ndarray:
        """The file as a read-only memory-mapped array."""
        fs, root = self._fs()
        full = posixpath.join(root, name)
        if fs is None:
            return np.memmap(full, dtype=dtype, mode="r") if os.path.getsize(full) else np.empty(0, dtype)
        with tempfile.TemporaryFile() as copy, fs.open_input_stream(full) as f:
            while block := f.read(1 << 22):
                copy.write(block)
            copy.flush()
            return np.memmap(copy, dtype=dtype, mode="r") if copy.tell() else np.empty(0, dtype)


class TokenBytes:
    """Texts -> their token ids as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and its pre-tokenizer never crosses a blank, so
    the chunks between blanks and newlines, encoded one by one, give the ids of the whole
    text.  Known chunks are kept per task, in two generations of at most ``LIMIT``.

    A chunk that is one word of Latin letters, with signs before or after it, is taken
    apart: the signs and the word are tokens of the pre-tokenizer each.  New words go
    through the merges alone, many at once, and are cut at the end-of-word ids.  Whether
    a tokenizer allows this is read from its file; all other chunks take the whole way.
    """

    LIMIT = 300_000
    TEXT_CHARS = 1 << 20
    SIGNS = re.escape(string.punctuation.replace("'", ""))
    WORD = re.compile(f"([{SIGNS}]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([{SIGNS}]*)")

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.merges = None
        if self._words_stand_alone():
            self.merges = Tokenizer.from_file(path)
            self.merges.normalizer = None
            self.merges.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _words_stand_alone(self) -> bool:
        """Lower-casing, runs of letters and runs of signs as tokens, an end-of-word suffix, no unknown id."""
        form = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (form["normalizer"] or {}).get("normalizers", [])]
        before = (form["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in before] == ["Split", "ByteLevel"]
                and before[0]["pattern"].get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
                and form["model"]["type"] == "BPE" and form["model"]["end_of_word_suffix"] == "</w>" and form["model"]["unk_token"] is None)

    def _slow(self, chunks: list[str]) -> None:
        for c, e in zip(chunks, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False), strict=True):
            self.known[c] = np.asarray(e.ids, dtype="<u4").tobytes()

    def _words(self, words: list[str]) -> None:
        """Lower-case words of Latin letters."""
        for i in range(0, len(words), 4096):
            some = words[i:i + 4096]
            ids = np.asarray(self.merges.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            data, begin = ids.tobytes(), 0
            for word, end in zip(some, ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist(), strict=True):
                self.known[word] = data[begin:end]
                begin = end

    def _learn(self, chunks: set[str], special: bool) -> None:
        """``special``: an added token of the vocabulary may occur in a chunk."""
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > self.LIMIT:
            self.older, self.known, new = self.known, {}, chunks
        old = [c for c in new if c in self.older]
        self.known.update((c, self.older[c]) for c in old)
        new = new.difference(old)
        if self.merges is None:
            self._slow(list(new))
            return
        matched = [m for m in map(self.WORD.fullmatch, new) if m and not (special and any(x in m[0] for x in self.added))]
        split = [(m[0], m[1], m[2].lower(), m[3]) for m in matched]
        signs = {s for _, a, _, b in split for s in (a, b)}
        self._slow(list(new.difference([c for c, *_ in split]).union(signs).difference(self.known)))
        self._words(list({w for _, _, w, _ in split}.difference(self.known)))
        self.known.update((c, self.known[a] + self.known[w] + self.known[b]) for c, a, w, b in split)

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order; texts are looked up together, up to TEXT_CHARS characters at once."""
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end] or "") <= self.TEXT_CHARS):
                size += len(texts[end] or "")
                end += 1
            chunks = [(t or "").replace("\n", " ").split(" ") for t in texts[begin:end]]
            special = self.merges is not None and any(x in t for t in texts[begin:end] if t for x in self.added)
            self._learn(set().union(*chunks), special)
            for c in chunks:
                yield b"".join(map(self.known.__getitem__, c))
            begin = end

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))
