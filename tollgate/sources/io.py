"""Sources and sinks: CSV, JSON lines, JSON documents, file manifests, whole-text corpora.

All readers take explicit schemas (no inference pass over the data) and all
writers are distributed DataFrame writes; nothing is funnelled through the driver.
"""

from __future__ import annotations

import csv
import hashlib
import sys
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# File blocks (S8, S10) are read in Python workers: shipped by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """header = sorted column names (the union of keys); every value as text."""
    df.select(*sorted(df.columns)).write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV read as all-string columns (callers cast); a missing path gives 0 rows.

    Columns are matched by each file's own header (the first line of each file; no
    inference pass), so files may differ in columns and order; requested columns absent
    from a file are null.
    """
    try:
        lines = spark.read.text(path)
    except Exception as e:  # noqa: BLE001 - only a missing path is tolerated
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], string_schema(columns))
        raise
    first = (lines.filter("_metadata.file_block_start = 0")
             .select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
             .groupBy("file").agg(F.min_by("value", "line").alias("header")))
    files: dict[str, list[str]] = {}
    for r in first.collect():                     # one row per file, as in Spark's own file listing
        files.setdefault(r["header"], []).append(r["file"])
    out = spark.createDataFrame([], string_schema(columns))
    for line, own in sorted(files.items()):
        header = next(csv.reader([line]))
        raw = (spark.read.schema(string_schema(header)).option("header", True).option("mode", "PERMISSIVE")
               .csv(path if len(files) == 1 else own))
        out = out.unionByName(raw.select(*[F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in columns]))
    return out


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines, overwrite or append."""
    df.write.mode("append" if append else "overwrite").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S3: JSON lines with a declared (nested) schema; malformed lines become null rows (PERMISSIVE)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_json_docs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Whole-file JSON documents (one document or array per file, pretty-printed allowed)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def to_json_doc(*cols: Column) -> Column:
    """Nested report document as JSON text."""
    return F.to_json(F.struct(*cols))


#: Bytes of a file that a task holds at once.
BLOCK_BYTES = 4 << 20


def _open(path: str):
    """Stream of a file of any store that a task can reach: local paths directly, others through pyarrow's file systems."""
    if path.startswith("file:") or "://" not in path:
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inner)


def _digest_files(batches):
    for d in batches:
        out = []
        for path in d["path"]:
            sha, size = hashlib.sha256(), 0
            with _open(path) as f:
                while block := f.read(BLOCK_BYTES):
                    sha.update(block)
                    size += len(block)
            out.append((path, sha.hexdigest(), size))
        yield pd.DataFrame(out, columns=["path", "sha256", "bytes"])


def _line_blocks(batches):
    for d in batches:
        for path in d["path"]:
            kept, number = b"", 0
            with _open(path) as f:
                while True:
                    block = f.read(BLOCK_BYTES)
                    data = kept + block
                    cut = data.rfind(b"\n") + 1 if block else len(data)
                    kept = data[cut:]
                    if cut:
                        yield pd.DataFrame({"path": [path], "block": [number], "text": [data[:cut].decode("utf-8", "replace")]})
                        number += 1
                    if not block:
                        break


def files_under(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Paths of the files under ``root`` (recursive), dealt out evenly; contents are not read.  Spark lists no empty files.

    ``glob`` keeps only matching file names (e.g. data files, not markers or the manifest's own output)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path").repartition(4 * spark.sparkContext.defaultParallelism, "path")


def file_manifest(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Relative path, sha256 and size of every file under ``root`` (recursive), sorted by path.

    Tasks read files block by block, so a file of any size needs no more memory than one block."""
    rel = F.regexp_replace(F.col("path"), r"^.*?" + root.rstrip("/").split("/")[-1] + "/", "")
    return (files_under(spark, root, glob).mapInPandas(_digest_files, "path string, sha256 string, bytes long")
                .select(rel.alias("path"), "sha256", "bytes").orderBy("path"))


def checksum_lines(df: DataFrame, sha: str = "sha256", path: str = "path") -> DataFrame:
    """S9: '<sha>  <path>' manifest lines."""
    return df.select(F.concat_ws("  ", F.col(sha), F.col(path)).alias("value"))


def corpus_text_scan(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """Texts of the matching files under ``root``: (path, block, text), blocks of whole lines of about BLOCK_BYTES.

    A small file is one block; a large one is read block by block, so no row holds it whole."""
    return files_under(spark, root, glob).mapInPandas(_line_blocks, "path string, block int, text string")


def keep_matching(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Keep rows whose label fully matches ``regex`` (anchored like a relabel keep rule)."""
    return df.filter(F.col(column).rlike(f"^(?:{regex})$"))
