"""Queries of this subpackage, each over its whole table, and SQL for those that have it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, html_extract, license_scan, lm_score, mixing, packing, quality_rules, simhash, substring_dedup, url_filter
from ._shared import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, render=substring_dedup.digest_of)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", *[F.round(c, 4).alias(c) for c in ("log10_score", "mean_log10")])


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_url_filter, op2_packing, op3_license_scan, op4_substring_dedup, op5_simhash, op6_lm_score, op7_html_extract, op8_ann,
        op9_quality_rules, op10_mixing, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": url_filter.sql(), "op3_license_scan": license_scan.sql(), "op4_substring_dedup": substring_dedup.sql(),
        "op6_lm_score": lm_score.sql(), "op9_quality_rules": quality_rules.sql(),
    }
