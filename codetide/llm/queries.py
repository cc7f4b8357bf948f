"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codetide.llm import decontamination, extraction, licenses, merkle, neardup, packing, quality, search, sharding, sketches, sql, tokencount, toxicity, warc
from codetide.llm.common import documents, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_query(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_query(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_query(documents(spark, sf_dir))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_text(read_table(spark, sf_dir, "pages"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_notices(documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_query(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_query(read_table(spark, sf_dir, "pages"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.neighbour_query(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_toxicity, op3_near_duplicates, op4_html_text, op5_licenses,
        op6_sharding, op7_packing, op8_decontamination, op9_token_counts, op10_warc,
        op11_search, op12_fingerprints, op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {"op1_quality_rules": sql.OP1, "op10_warc": sql.OP10, "op11_search": sql.OP11, "op13_merkle_manifest": sql.OP13}
