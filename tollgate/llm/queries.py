"""Registered queries of the training-data operators: op1 to op13."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import decontam, hardneg, htmltext, kneserney, langid, minhash, packing, pseudonyms, quality, setjoin, spelling, tokencounts, urlfilter
from tollgate.sources.tables import table

TOKENIZER = "word_bpe_49k.json"
#: The rules of the url query (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "n_replaced")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.url_verdicts(table(spark, sf_dir, "pages"), rules)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_pages(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kneserney.score_held_out(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_classes(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
r(r_host, r_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
urls AS (SELECT DISTINCT host, path FROM v),
hit AS (
  SELECT host, path, r_host || r_path AS rule, verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS k
  FROM urls JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT v.page_id, v.host, v.path, hit.rule, coalesce(hit.verdict, 'allow') AS verdict
FROM v LEFT JOIN hit ON v.host = hit.host AND v.path = hit.path AND hit.k = 1
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_minhash, op2_decontamination, op3_packing, op4_pseudonyms, op5_token_counts, op6_url_filter, op7_html_text, op8_language_id,
    op9_quality_rules, op10_kneser_ney, op11_spelling_variants, op12_hard_negatives, op13_jaccard_join)}
ORACLE = {"op6_url_filter": OP6_SQL}
