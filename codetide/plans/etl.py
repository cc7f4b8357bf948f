"""Archives to clean events to marts, each stage stored once and read from there."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.operators.cleaning import clean_events
from codetide.operators.marts import hourly_mart, language_mart, repo_mart
from codetide.schemas import TABLES
from codetide.session import require_utc
from codetide.sources.archives import read_archives
from codetide.sources.tables import ensure_database, overwrite_table

#: Stored marts, each partitioned by day, and what they are built with.
MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "mart_language_activity": language_mart,
    "mart_repo_activity": repo_mart,
    "mart_hourly_activity": hourly_mart,
}


def dated(df: DataFrame, column: str) -> DataFrame:
    """Adds the partition column of the stored tables."""
    return df.withColumn("event_date", F.to_date(column))


def store_events(raw: DataFrame, database: str, as_of: dt.datetime | None = None) -> DataFrame:
    """Clean raw events into the event table and return that table. The index of ids is emptied; the next load of arrivals builds it."""
    overwrite_table(raw.sparkSession.createDataFrame([], TABLES["event_days"].schema), f"{database}.event_days")
    overwrite_table(dated(clean_events(raw, as_of), "created_at"), f"{database}.events_parsed")
    return raw.sparkSession.table(f"{database}.events_parsed")


def store_marts(events: DataFrame, database: str) -> None:
    """Build the three marts from the stored events; each reads only its own columns."""
    for name, build in MARTS.items():
        overwrite_table(dated(build(events), "hour"), f"{database}.{name}")


def run_etl(
    spark: SparkSession, path: str, database: str = "codetide", as_of: dt.datetime | None = None
) -> None:
    """The whole pipeline; the archives are parsed once. A rerun leaves the same tables."""
    require_utc(spark)
    ensure_database(spark, database)
    store_marts(store_events(read_archives(spark, path), database, as_of), database)
