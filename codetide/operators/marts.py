"""Hourly marts by language, repository and event type.

The exact distinct counts are left to Catalyst: it first groups by (key, distinct value),
combining in each task before the shuffle, which also spreads one busy key over all tasks.
With ``approximate`` they are sketches instead: one row per key and task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetide.functions.time import hour_of
from codetide.schemas import FORK, PULL_REQUEST, PUSH, STAR, UNKNOWN_LANGUAGE


def of_type(event_type: str) -> Column:
    return F.count_if(F.col("event_type") == event_type)


def distinct(column: str, approximate: bool = False) -> Column:
    """Distinct values, nulls not counted."""
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def _hour() -> Column:
    return hour_of(F.col("created_at")).alias("hour")


def known_language(events: DataFrame) -> DataFrame:
    return events.where(F.col("language") != UNKNOWN_LANGUAGE)


def language_mart(events: DataFrame, approximate: bool = False) -> DataFrame:
    return known_language(events).groupBy(_hour(), "language").agg(
        F.count("event_id").alias("total_events"),
        distinct("actor_id", approximate).alias("unique_actors"),
        of_type(PUSH).alias("push_count"),
        of_type(STAR).alias("star_count"),
        of_type(PULL_REQUEST).alias("pr_count"),
        of_type(FORK).alias("fork_count"),
    )


def repo_mart(events: DataFrame, approximate: bool = False) -> DataFrame:
    return events.groupBy(_hour(), "repo_id", "repo_name").agg(
        F.count("event_id").alias("total_events"),
        distinct("actor_id", approximate).alias("unique_actors"),
        of_type(STAR).alias("stars_gained"),
        of_type(FORK).alias("forks_gained"),
        F.sum("commits_count").alias("total_commits"),
    )


def hourly_mart(events: DataFrame, approximate: bool = False) -> DataFrame:
    return events.groupBy(_hour(), "event_type").agg(
        F.count("event_id").alias("event_count"),
        distinct("actor_id", approximate).alias("unique_users"),
        distinct("repo_id", approximate).alias("unique_repos"),
    )


#: Logarithm of a sketch's number of registers, and the relative deviation of its estimate.
LG_REGISTERS = 12
SKETCH_DEVIATION = 1.04 / 2 ** (LG_REGISTERS / 2)


def uniques_mart(events: DataFrame) -> DataFrame:
    """Per hour the counts of a period's report and sketches of the actors and repositories, which can be united over any hours."""
    return events.groupBy(_hour()).agg(
        F.count(F.lit(1)).alias("events"),
        of_type(STAR).alias("stars"),
        of_type(FORK).alias("forks"),
        of_type(PULL_REQUEST).alias("prs"),
        of_type(PUSH).alias("pushes"),
        F.hll_sketch_agg("actor_id", LG_REGISTERS).alias("actor_sketch"),
        F.hll_sketch_agg("repo_id", LG_REGISTERS).alias("repo_sketch"),
    )


def merge_mart(mart: DataFrame, keys: list[str], additive: list[str]) -> DataFrame:
    """Add up rows of the same key. Distinct counts are not additive and must not be listed."""
    return mart.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in additive])
