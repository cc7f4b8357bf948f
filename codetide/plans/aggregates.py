"""Stored aggregates that reports and snapshots read instead of events: hourly sketches and feature panes.

Both are optional tables, kept by day: a load replaces the days, or the panes of the days, that it has touched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.operators.features import activity_from_panes, actor_panes, pane_half_days
from codetide.operators.marts import uniques_mart
from codetide.operators.snapshots import Windows
from codetide.plans.etl import dated
from codetide.session import materialise
from codetide.sources.tables import ensure_optional, overwrite_listed, overwrite_table


def _events(spark: SparkSession, database: str, days: list[dt.date] | None) -> DataFrame:
    events = spark.table(f"{database}.events_parsed")
    return events if days is None else events.where(F.col("event_date").isin(days))


def stored_bounds(spark: SparkSession, database: str) -> DataFrame:
    """First and last day of the event table, from the names of its partitions; no file is opened."""
    day = F.to_date(F.regexp_extract("partition", r"event_date=([0-9-]+)", 1))
    return spark.sql(f"SHOW PARTITIONS {database}.events_parsed").agg(F.min(day).alias("first_event"), F.max(day).alias("last_event"))


def update_uniques(spark: SparkSession, database: str, days: list[dt.date] | None = None) -> None:
    """Hourly counts and sketches of the given days, or of all."""
    table = ensure_optional(spark, database, "mart_hourly_uniques")
    mart = dated(uniques_mart(_events(spark, database, days)), "hour")
    if days is None:
        overwrite_table(mart, table)
    else:
        overwrite_listed(materialise(mart, "uniques"), table, "event_date", days)


def pane_days(days: list[dt.date], anchor: dt.date, length: int) -> tuple[list[dt.date], list[dt.date]]:
    """First days of the panes that the given days belong to, and all days that those panes have events of."""
    half = lambda day: 2 * (day - anchor).days
    panes = {h // length for day in days for h in (half(day), half(day) + 1)}
    starts = {pane * length // 2 for pane in panes}
    # A pane that begins at noon shares its first day with the one before, and both are rewritten.
    panes |= {pane + step for pane in panes for step in (-1, 1) if (pane + step) * length // 2 in starts}
    covered = {h // 2 for pane in panes for h in range(pane * length, (pane + 1) * length)}
    return tuple(sorted(anchor + dt.timedelta(days=k) for k in found) for found in (starts, covered))


def update_panes(spark: SparkSession, database: str, windows: Windows = Windows(), days: list[dt.date] | None = None) -> None:
    """Panes of the given days, or of all; also all where the history begins earlier than it did, as panes are counted from there."""
    table, length = ensure_optional(spark, database, "feature_panes"), pane_half_days(windows)
    events = _events(spark, database, None)
    bounds = stored_bounds(spark, database)
    first = bounds.select(F.date_add(F.to_date("first_event"), windows.obs_days)).first()[0]
    if first is None:
        return
    held = spark.table(table).select("anchor", "half_days").limit(1).collect()
    if days is not None and held == [(first, length)]:
        starts, covered = pane_days(days, first, length)
        events = _events(spark, database, covered)
    else:
        starts = None
    pane_day = F.date_add(F.lit(first), F.floor(F.col("pane") * length / 2).cast("int"))
    panes = actor_panes(events, windows, bounds).withColumns(
        {"anchor": F.lit(first), "half_days": F.lit(length), "pane_day": pane_day}
    )
    if starts is None:
        overwrite_table(panes, table)
    else:
        overwrite_listed(materialise(panes.where(F.col("pane_day").isin(starts)), "panes"), table, "pane_day", starts)


def stored_activity(spark: SparkSession, database: str, windows: Windows = Windows()) -> DataFrame:
    """``repo_activity`` from the stored panes; the bounds come from the partitions of the event table."""
    panes, bounds = spark.table(f"{database}.feature_panes"), stored_bounds(spark, database)
    held = panes.select("anchor", "half_days").limit(1).collect()
    first = bounds.select(F.date_add(F.to_date("first_event"), windows.obs_days)).first()[0]
    if held and held != [(first, pane_half_days(windows))]:
        raise ValueError("the stored panes are of other windows or of a shorter history: run update_panes")
    return activity_from_panes(panes.drop("anchor", "half_days", "pane_day"), windows, bounds)
