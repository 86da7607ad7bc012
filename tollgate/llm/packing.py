"""Vector bin packing of tokenised documents into training sequences.

A sequence has three limits at once: tokens, segments (pieces) and loss-bearing tokens.
Every task packs its own documents, with no shuffle: a long document first fills
whole sequences; the rests wait in a pool of at most ``POOL`` pieces.  From the pool
the next piece for the open sequence is the one that fits and whose demand vector
has the largest dot product with the room that is left (both as shares of the
limits).  When none fits, the best one is cut so that the tokens or the loss-bearing
tokens are filled exactly.  A sequence that another limit closes before its tokens are full ends at the
greatest power of two, which needs no padding, and its rest stays open; so does the last open one at a task's end.

Defined results: null or empty text is the end id alone; a null doc_id is passed
through; repeated rows are packed as often as they occur; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import TokenBytes, chunked, column

END_ID = 2
POOL = 1024
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long, padded_to long"


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096


@dataclass
class Piece:
    doc: int | None
    ids: bytes             # the whole document's ids, 4 bytes each
    loss: np.ndarray | None  # running count of loss-bearing tokens, or None: all bear loss
    start: int
    length: int

    def losses(self, length: int | None = None) -> int:
        n = self.length if length is None else length
        return n if self.loss is None else int(self.loss[self.start + n] - self.loss[self.start])

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.ids, self.loss, self.start, n), Piece(self.doc, self.ids, self.loss, self.start + n, self.length - n)

    def longest(self, tokens: int, losses: int) -> int:
        """The longest prefix within both rooms."""
        n = min(self.length, tokens)
        if self.loss is None:
            return min(n, losses)
        return min(n, int(np.searchsorted(self.loss, self.loss[self.start] + losses, side="right")) - 1 - self.start)


class Packer:
    """Packs the pieces of one task; ``out`` collects finished rows."""

    def __init__(self, limits: Limits, task: int):
        self.limits, self.next_id, self.out = limits, task << 32, []
        self.pieces: list[Piece] = []
        self.demand = np.zeros((2 * POOL, 3))
        self.full = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        self.open: list[Piece] = []
        self.room = self.full.copy()

    def emit(self, pieces: list[Piece], padded_to: int | None = None) -> None:
        offset = 0
        for p in pieces:
            self.out.append((p.doc, p.start, p.length, zlib.crc32(p.ids[4 * p.start:4 * (p.start + p.length)]), len(p.ids) // 4,
                             self.next_id, offset, p.losses(), padded_to or self.limits.tokens))
            offset += p.length
        self.next_id += 1

    def add(self, p: Piece) -> None:
        while p.length >= self.limits.tokens or p.losses() >= self.limits.loss_tokens:
            n = p.longest(self.limits.tokens, self.limits.loss_tokens)
            if n < self.limits.tokens:  # the loss limit binds: the sequence can take more tokens that bear none
                break
            head, p = p.cut(n)
            self.emit([head])
        if p.length:
            self.put(p)
            while len(self.pieces) >= POOL:
                self.fill()

    def put(self, p: Piece) -> None:
        i = len(self.pieces)
        self.pieces.append(p)
        if i == len(self.demand):
            self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
        self.demand[i] = (p.length, 1, p.losses())

    def take(self, i: int) -> Piece:
        p, last = self.pieces[i], len(self.pieces) - 1
        self.pieces[i], self.demand[i] = self.pieces[last], self.demand[last]
        self.pieces.pop()
        return p

    def fill(self) -> None:
        """Closes one sequence, or leaves it open when the pool is empty."""
        while self.pieces:
            d = self.demand[:len(self.pieces)]
            score = (d / self.full) @ (self.room / self.full)
            fits = (d <= self.room).all(axis=1)
            if self.room[1] < 1 or self.room[0] < 1:
                break
            if fits.any():
                self.place(self.take(int(np.argmax(np.where(fits, score, -1)))))
                continue
            p = self.take(int(np.argmax(score)))
            n = p.longest(int(self.room[0]), int(self.room[2]))
            if n:
                p, rest = p.cut(n)
                self.place(p)
                self.put(rest)
            else:  # no room for a loss-bearing token
                self.put(p)
                break
        else:
            return
        self.close()

    def place(self, p: Piece) -> None:
        self.open.append(p)
        self.room -= (p.length, 1, p.losses())

    def close(self) -> None:
        """Emits the open sequence if its tokens are full, else its greatest power of two; the rest stays open."""
        total = sum(p.length for p in self.open)
        size = total if total == self.limits.tokens else 1 << (total.bit_length() - 1)
        now, left, need = [], self.open, size
        while need:
            p = left.pop(0)
            if p.length > need:
                p, rest = p.cut(need)
                left.insert(0, rest)
            now.append(p)
            need -= p.length
        self.emit(now, padded_to=size)
        self.open, self.room = [], self.full.copy()
        for p in left:
            self.place(p)

    def finish(self) -> None:
        while self.pieces:
            self.fill()
        while self.open:
            self.close()

    def rows(self) -> pa.RecordBatch:
        cols = list(zip(*self.out, strict=True)) or [()] * 9
        self.out = []
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                               names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "padded_to"])


def pack(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = END_ID) -> DataFrame:
    """Packs ``doc_id`` with ``text``, or with ``parts`` array<struct<text string, loss boolean>>
    (instruction data: a part's tokens bear loss or not; the end id does with the last part)."""
    parts = "parts" in docs.columns
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = TokenBytes(tokenizer), Packer(limits, TaskContext.get().partitionId())
        for b in chunked(batches, 256):
            bodies = column(b, "parts" if parts else "text").to_pylist()
            whole = iter(bodies) if parts else tokens.encode_all(bodies)
            for doc, body in zip(column(b, "doc_id").to_pylist(), whole, strict=True):
                if not parts:
                    ids, loss = body + end, None
                else:
                    own = [(tokens.encode(x["text"]), bool(x["loss"])) for x in body or [] if x]
                    ids = b"".join(x for x, _ in own) + end
                    bears = np.concatenate([np.full(len(x) // 4, y) for x, y in own] + [np.array([own[-1][1] if own else True])])
                    loss = np.concatenate(([0], np.cumsum(bears)))
                packer.add(Piece(doc, ids, loss, 0, len(ids) // 4))
            yield packer.rows()
        packer.finish()
        yield packer.rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "parts" if parts else "text").mapInArrow(run, SCHEMA)
