"""Raw events to the flat, valid, deduplicated event table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetide.functions.time import instant
from codetide.schemas import PUSH, TARGET_TYPES, UNKNOWN_LANGUAGE

# Bounds of a plausible event.
EARLIEST = dt.datetime(2020, 1, 1)
MAX_PUSH_SIZE = 10_000


def target_events(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("type").isin(*TARGET_TYPES))


def parse_time(raw: DataFrame) -> DataFrame:
    """``created_at`` as a timestamp, null where the text is not one."""
    return raw.withColumn("created_at", F.try_to_timestamp("created_at"))


def has_identity(raw: DataFrame) -> DataFrame:
    """Events with an id, a repository id and a repository name that is not empty."""
    # The comparison with the empty name also drops the missing name.
    return raw.where(F.col("id").isNotNull() & F.col("repo.id").isNotNull() & (F.col("repo.name") != ""))


def plausible_time(raw: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Events between 2020 and ``as_of`` (default: now); one without a time drops out, too."""
    latest = F.current_timestamp() if as_of is None else instant(as_of)
    return raw.where(F.col("created_at").between(instant(EARLIEST), latest))


def without_bot_pushes(raw: DataFrame) -> DataFrame:
    """All events but pushes of more than 10,000 commits; a push without a size stays."""
    size = F.coalesce(F.col("payload.size"), F.lit(1))
    return raw.where((F.col("type") != PUSH) | (size <= MAX_PUSH_SIZE))


def resolved_language() -> Column:
    """Language of the pull request's base repository, else of the fork, else unknown."""
    return F.coalesce(
        F.col("payload.pull_request.base.repo.language"),
        F.col("payload.forkee.language"),
        F.lit(UNKNOWN_LANGUAGE),
    )


def flatten(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        resolved_language().alias("language"),
        F.coalesce(F.col("payload.size"), F.lit(0)).alias("commits_count"),
        F.col("payload.action").alias("action"),
        "created_at",
    )


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per event id: the earliest, and among equals the smallest of the whole row.

    A minimum combines copies before the shuffle, so an id with many copies costs one row
    per task, and the row kept does not depend on the order of the input.
    """
    rest = [c for c in events.columns if c not in ("event_id", "created_at")]
    return (
        events.groupBy("event_id")
        .agg(F.min(F.struct("created_at", *rest)).alias("kept"))
        .select(*[F.col("event_id") if c == "event_id" else F.col(f"kept.{c}") for c in events.columns])
    )


def clean_events(raw: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Keep target types, drop invalid rows and outliers, flatten, deduplicate.

    The filters run before the deduplication: they need no shuffle and shrink the one that
    follows, and an invalid copy cannot displace a valid one.
    """
    timed = parse_time(target_events(raw))
    valid = without_bot_pushes(plausible_time(has_identity(timed), as_of))
    return dedup_events(flatten(valid))
