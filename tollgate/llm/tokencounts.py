"""Token counts of flat, unindexed token files, by a scan for the end-of-document id.

A file is a row of little-endian unsigned 16-bit ids, each document closed by the
separator.  ``scan`` cuts the files into blocks of equal size without regard to
documents; a task searches a block for the separator in one vectorised compare.  A
document may span any number of blocks: the boundaries are stitched by a prefix scan
over the blocks' counts (how many separators stand before, where the last one stands),
first inside groups of ``GROUP`` blocks and then over the groups, so that a single huge
file is not one task's work.

``write_tokens`` makes such files from a table of texts: each task appends its
documents' ids to one file and reports which documents it wrote, in order.

Defined results: null or empty text is a separator alone, 0 tokens; ids after the last
separator of a file form a last document with ``closed`` = false; null and repeated
doc_ids are passed through; an empty table writes no files and gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm.common import SharedFolder, TokenBytes, chunked, column

DTYPE, WIDTH = "<u2", 2
SEPARATOR = 49407
BLOCK_TOKENS = 1 << 20
GROUP = 256


def write_tokens(docs: DataFrame, folder: SharedFolder, tokenizer: str, separator: int = SEPARATOR) -> DataFrame:
    """Writes one flat file per task; rows (file, n_tokens of the file, ordinal, doc_id), one per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, tokens = f"tokens-{TaskContext.get().partitionId():06d}.u16", TokenBytes(tokenizer, special=True)
        end = np.array([separator], dtype=DTYPE).tobytes()
        stream, commit = folder.writer(name)
        ordinal, size = 0, 0
        for b in chunked(batches, 512):
            for ids in tokens.encode_all(column(b, "text").to_pylist()):
                data = np.frombuffer(ids, dtype="<u4").astype(DTYPE).tobytes()
                stream.write(data + end)
                size += len(data) + len(end)
            n = b.num_rows
            yield pa.record_batch([pa.array([name] * n), pa.array(range(ordinal, ordinal + n), pa.int64()), column(b, "doc_id"),
                                   pa.array([size // WIDTH] * n, pa.int64())], names=["file", "ordinal", "doc_id", "n_ids"])
            ordinal += n
        commit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "file string, ordinal long, doc_id long, n_ids long")


def blocks(files: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, n_ids) -> (file, block, begin, n): equal blocks."""
    last = F.floor((F.col("n_ids") - 1) / F.lit(block_tokens))
    return (files.filter("n_ids > 0").select("file", "n_ids", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("block"))
            .select("file", "block", (F.col("block") * block_tokens).alias("begin"),
                    F.least(F.lit(block_tokens).cast("long"), F.col("n_ids") - F.col("block") * block_tokens).alias("n")))


def scan(files: DataFrame, folder: SharedFolder, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents of flat files: (file, ordinal, start, n_tokens without the separator, closed)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = np.frombuffer(folder.read(row["file"], row["begin"] * WIDTH, row["n"] * WIDTH), dtype=DTYPE)
                at = np.flatnonzero(ids == separator) + row["begin"]
                yield pa.record_batch([pa.array([row["file"]]), pa.array([row["block"]], pa.int64()), pa.array([row["begin"]], pa.int64()),
                                       pa.array([len(ids)], pa.int64()), pa.array([at], pa.list_(pa.int64()))],
                                      names=["file", "block", "begin", "n", "at"])

    spread = blocks(files, block_tokens).repartition("file", "block")
    found = spread.mapInArrow(search, "file string, block long, begin long, n long, at array<long>").checkpoint()
    facts = found.select("file", "block", F.floor(F.col("block") / GROUP).alias("grp"), F.size("at").cast("long").alias("seps"),
                         F.element_at(F.when(F.size("at") > 0, F.col("at")), -1).alias("last_sep"), (F.col("begin") + F.col("n")).alias("end"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    groups = facts.groupBy("file", "grp").agg(F.sum("seps").alias("seps"), F.max("last_sep").alias("last_sep"), F.max("end").alias("end"))
    over = before(Window.partitionBy("file").orderBy("grp"))
    groups = groups.select("file", "grp", F.coalesce(F.sum("seps").over(over), F.lit(0)).alias("g_seps"), F.max("last_sep").over(over).alias("g_last"))
    inside = before(Window.partitionBy("file", "grp").orderBy("block"))
    prefix = (facts.select("file", "grp", "block", F.coalesce(F.sum("seps").over(inside), F.lit(0)).alias("b_seps"), F.max("last_sep").over(inside).alias("b_last"))
              .join(groups, ["file", "grp"])
              .select("file", "block", (F.col("g_seps") + F.col("b_seps")).alias("first_ordinal"),
                      (F.coalesce(F.greatest("g_last", "b_last"), F.lit(-1)) + 1).alias("first_start")))
    stitched = found.join(prefix, ["file", "block"])
    closed = stitched.filter(F.size("at") > 0).select(
        "file", "first_ordinal", F.posexplode(F.arrays_zip(F.col("at").alias("sep"), F.concat(
            F.array("first_start"), F.transform(F.slice("at", 1, F.size("at") - 1), lambda x: x + 1)).alias("start"))).alias("i", "x")).select(
        "file", (F.col("first_ordinal") + F.col("i")).alias("ordinal"), F.col("x.start").alias("start"),
        (F.col("x.sep") - F.col("x.start")).alias("n_tokens"), F.lit(True).alias("closed"))
    ends = facts.groupBy("file").agg(F.sum("seps").alias("ordinal"), (F.coalesce(F.max("last_sep"), F.lit(-1)) + 1).alias("start"), F.max("end").alias("end"))
    open_ = ends.filter("start < end").select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.union(open_)


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per document of a table: doc_id, file, ordinal, start, n_tokens, as found in the flat files."""
    folder = SharedFolder.new(spark, "tokens")
    wrote = write_tokens(docs, folder, tokenizer).checkpoint()
    files = wrote.groupBy("file").agg(F.max("n_ids").alias("n_ids"))
    return (scan(files, folder).join(wrote.select("file", "ordinal", "doc_id"), ["file", "ordinal"])
            .select("doc_id", "file", "ordinal", "start", "n_tokens"))
