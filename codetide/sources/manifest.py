"""Hour manifests: which archives a period consists of, and which of them are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.sources.archives import archive_name, not_landed, source_key


def hours_of_days(period: DataFrame) -> DataFrame:
    """All 24 hours of each day from ``first_day`` to ``last_day`` (columns, both included)."""
    start = F.col("first_day").cast("timestamp")
    end = F.date_add("last_day", 1).cast("timestamp") - F.expr("interval 1 hour")
    hours = F.when(
        F.col("first_day") <= F.col("last_day"), F.sequence(start, end, F.expr("interval 1 hour"))
    )
    return _named(period.select(F.explode(hours).alias("hour")))


def hours_from(start: DataFrame) -> DataFrame:
    """``n_hours`` hours from ``start_hour`` of ``first_day`` on (columns), over midnights."""
    offset = F.make_interval(hours=F.col("start_hour") + F.col("step").cast("int"))
    steps = F.when(F.col("n_hours") > 0, F.sequence(F.lit(0), F.col("n_hours") - 1))
    hours = start.select("*", F.explode(steps).alias("step"))
    return _named(hours.select((F.col("first_day").cast("timestamp") + offset).alias("hour")))


def _named(hours: DataFrame) -> DataFrame:
    return hours.select(
        F.to_date("hour").alias("event_date"),
        F.hour("hour").alias("event_hour"),
        archive_name(F.col("hour")).alias("file_name"),
    )


def missing_hours(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Archives of the manifest that are not landed yet."""
    return not_landed(manifest, landed).select("event_date", "event_hour", "file_name")


def backfill_progress(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """One row: hours to fetch and hours skipped because they are landed already."""
    known = landed.select("source_file", F.lit(True).alias("is_landed")).distinct()
    return (
        manifest.withColumn("source_file", source_key(F.col("file_name")))
        .join(known, "source_file", "left")
        .agg(
            F.count_if(F.col("is_landed").isNull()).alias("to_fetch"),
            F.count_if(F.col("is_landed")).alias("skipped"),
        )
    )
