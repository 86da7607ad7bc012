"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs; all but the last return the columns of documents.
Nulls in any column, empty and very long texts, repeated rows and empty tables are
handled as the stages' operators state."""

from __future__ import annotations

import posixpath
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import decontam, minhash, packing, pseudonyms, quality
from tollgate.llm.queries import TOKENIZER
from tollgate.session import checkpoint_root
from tollgate.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the row of the smallest doc_id."""
    return minhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced; n_chars follows the text."""
    return pseudonyms.pseudonymise(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


STAGES = [("quality_rules", quality_rules), ("minhash_near_dedup", near_dedup), ("benchmark_decontamination", decontaminate),
          ("pii_pseudonyms", pseudonymise), ("vector_packing", pack)]

#: Packing and tokens have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = posixpath.join(checkpoint_root(spark), f"corpus-pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = posixpath.join(folder, f"{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
