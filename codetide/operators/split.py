"""Language buckets, repository-wise split, class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codetide.functions.hashing import hash32
from codetide.schemas import UNKNOWN_LANGUAGE

TOP_LANGUAGES = 15
OTHER_LANGUAGE = "other"
SPLIT_SEED = 42
TEST_PERCENT = 25
VALIDATION_PERCENT = 15


def language_or_unknown() -> Column:
    return F.coalesce(F.col("language"), F.lit(UNKNOWN_LANGUAGE))


def top_languages(rows: DataFrame, n: int = TOP_LANGUAGES) -> DataFrame:
    """The ``n`` languages with the most rows, ties by name."""
    return (
        rows.groupBy(language_or_unknown().alias("language"))
        .agg(F.count(F.lit(1)).alias("language_rows"))
        .orderBy(F.desc("language_rows"), "language")
        .limit(n)
    )


def with_language_bucket(rows: DataFrame, top: DataFrame) -> DataFrame:
    """``lang_bucket``: the language where it is among ``top`` (at most 15 rows), else other."""
    kept = F.broadcast(top.select(F.col("language").alias("_top")))
    language = language_or_unknown()
    return rows.join(kept, language == F.col("_top"), "left").withColumn(
        "lang_bucket", F.coalesce(F.col("_top"), F.lit(OTHER_LANGUAGE))
    ).drop("_top")


def _percentile_bucket(seed: int, *parts: Column) -> Column:
    return F.pmod(hash32(F.lit(seed), *parts), F.lit(100))


def with_split(rows: DataFrame, seed: int = SPLIT_SEED, test_percent: int = TEST_PERCENT) -> DataFrame:
    """``is_test`` by a hash of the repository, so that all its snapshots fall on one side."""
    return rows.withColumn("is_test", _percentile_bucket(seed, F.col("repo_id")) < test_percent)


def with_validation(
    rows: DataFrame, seed: int = SPLIT_SEED, percent: int = VALIDATION_PERCENT
) -> DataFrame:
    """``is_validation``: a slice of the training repositories kept for early stopping."""
    bucket = _percentile_bucket(seed + 1, F.col("repo_id"))
    return rows.withColumn("is_validation", bucket < percent)


def class_weights(rows: DataFrame, label: str = "abandoned") -> DataFrame:
    """Balanced weight n / (classes · n_class) of each class; one row per class."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    # A window over the few counted rows, so that the input is read once.
    classes = Window.partitionBy(F.lit(1))
    n, kinds = F.sum("class_rows").over(classes), F.count(F.lit(1)).over(classes)
    return counts.withColumn("class_weight", n / (kinds * F.col("class_rows")))


def with_class_weight(rows: DataFrame, label: str = "abandoned") -> DataFrame:
    """Joins the weights back; the broadcast side has one row per class."""
    weights = class_weights(rows, label).drop("class_rows")
    return rows.join(F.broadcast(weights), label)
