"""One query for each operator, over whole tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decontamination, labelled, language_model, minhash, packing, pii, quality_classifier, quality_rules, token_files, toxicity, url_filter
from freshet.llm.storage import new_path

#: The rules of op2: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _marked(scored: DataFrame) -> DataFrame:
    return scored.withColumn("held_out", F.coalesce(labelled.remainder(F.col("doc_id"), 3) == 1, F.lit(False)))


def op1_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels, fold=labelled.remainder(F.col("doc_id"), 3) != 1)
    return _marked(quality_classifier.classify(docs, model)).select("doc_id", "held_out", "score", "predicted")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return token_files.digest_tokens(spark, path)


def op9_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, fold=labelled.remainder(F.col("doc_id"), 3) != 1)
    return _marked(toxicity.classify(docs, model)).select("doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bradley_terry": op1_bradley_terry,
    "op2_url_filter": op2_url_filter,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_packing": op5_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_minhash": op7_minhash,
    "op8_token_files": op8_token_files,
    "op9_interpolation": op9_interpolation,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL: dict[str, str] = {}

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLE_SQL["op2_url_filter"] = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
)
SELECT page_id, host, path,
  (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
  coalesce((SELECT arg_max(rule_verdict, length(rule_host || rule_path)) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parts
"""
