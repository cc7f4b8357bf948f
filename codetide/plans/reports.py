"""Activity reports over clean events and marts; every parameter is a bound value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codetide.functions.numeric import half_even, share
from codetide.functions.time import days_in, in_period, iso_weekday
from codetide.operators.marts import distinct, known_language, of_type
from codetide.schemas import FORK, PULL_REQUEST, PUSH, STAR

# Lengths of the report tables.
LANGUAGE_ROWS = 25
DEFAULT_LANGUAGES = 8
REPO_ROWS = 20
REPO_METRICS = ("stars", "forks", "pushes", "events")


def kpi(
    events: DataFrame, first_day: dt.date, last_day: dt.date, approximate: bool = False
) -> DataFrame:
    """Totals of a period and events per day; actors and repositories exact unless ``approximate``."""
    totals = in_period(events, "created_at", first_day, last_day).agg(
        F.count(F.lit(1)).alias("events"),
        distinct("actor_id", approximate).alias("actors"),
        distinct("repo_id", approximate).alias("repos"),
        of_type(STAR).alias("stars"),
        of_type(FORK).alias("forks"),
        of_type(PULL_REQUEST).alias("prs"),
        of_type(PUSH).alias("pushes"),
    )
    return totals.withColumn("events_per_day", F.col("events") / days_in(first_day, last_day))


def kpi_sketch(uniques: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """``kpi`` from the mart of hourly sketches alone: a row per hour is read, whatever the number of events.

    Actors and repositories are estimates with a relative deviation of ``SKETCH_DEVIATION``; all else is exact.
    """
    counts = ("events", "stars", "forks", "prs", "pushes")
    totals = in_period(uniques, "hour", first_day, last_day).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts),
        *(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(f"{c}s") for c in ("actor", "repo")),
    )
    return totals.withColumn("events_per_day", F.col("events") / days_in(first_day, last_day))


def peak_hour_of_a_type(hourly: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Most events of one type in one hour."""
    return in_period(hourly, "hour", first_day, last_day).agg(F.max("event_count").alias("peak"))


def peak_hour(hourly: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Most events of all types together in one hour."""
    per_hour = in_period(hourly, "hour", first_day, last_day).groupBy("hour").agg(
        F.sum("event_count").alias("events")
    )
    return per_hour.agg(F.max("events").alias("peak"))


def daily_events(hourly: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    return (
        in_period(hourly, "hour", first_day, last_day)
        .groupBy(F.to_date("hour").alias("day"))
        .agg(F.sum("event_count").alias("events"))
        .orderBy("day")
    )


def type_mix(hourly: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Events per type, most first, and each type's share of all."""
    per_type = in_period(hourly, "hour", first_day, last_day).groupBy("event_type").agg(
        F.sum("event_count").alias("events")
    )
    # The window covers one row per event type.
    total = F.sum("events").over(Window.partitionBy())
    return per_type.withColumn("share", share(F.col("events"), total)).orderBy(
        F.desc("events"), "event_type"
    )


def weekday_hours(hourly: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Events by weekday (Monday = 1) and hour of day, where there are any."""
    return (
        in_period(hourly, "hour", first_day, last_day)
        .groupBy(iso_weekday(F.col("hour")).alias("dow"), F.hour("hour").alias("h"))
        .agg(F.sum("event_count").alias("events"))
    )


def weekday_hour_grid(hourly: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """The same on the full grid of 7 by 24 cells, 0 where there are no events."""
    cells = hourly.sparkSession.range(7 * 24).select(
        (F.floor(F.col("id") / 24) + 1).cast("int").alias("dow"), (F.col("id") % 24).cast("int").alias("h")
    )
    # The aggregated side has at most 168 rows.
    busy = F.broadcast(weekday_hours(hourly, first_day, last_day))
    return cells.join(busy, ["dow", "h"], "left").select(
        "dow", "h", F.coalesce("events", F.lit(0)).alias("events")
    )


def language_stats(
    events: DataFrame, first_day: dt.date, last_day: dt.date, n: int = LANGUAGE_ROWS
) -> DataFrame:
    """The ``n`` known languages with the most events, ties by name."""
    return (
        known_language(in_period(events, "created_at", first_day, last_day))
        .groupBy("language")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("actor_id").alias("actors"),
            of_type(STAR).alias("stars"),
            of_type(FORK).alias("forks"),
            of_type(PULL_REQUEST).alias("prs"),
        )
        .orderBy(F.desc("events"), "language")
        .limit(n)
    )


def language_trend(
    events: DataFrame,
    first_day: dt.date,
    last_day: dt.date,
    languages: list[str] | None = None,
) -> DataFrame:
    """Events and stars per day of the given languages, by default the eight largest."""
    period = in_period(events, "created_at", first_day, last_day)
    if languages is None:
        # Eight rows.
        largest = language_stats(events, first_day, last_day, DEFAULT_LANGUAGES).select("language")
        period = period.join(F.broadcast(largest), "language", "left_semi")
    else:
        period = period.where(F.col("language").isin(*languages))
    return (
        period.groupBy(F.to_date("created_at").alias("day"), "language")
        .agg(F.count(F.lit(1)).alias("events"), of_type(STAR).alias("stars"))
        .orderBy("day", "language")
    )


def top_repos(
    events: DataFrame,
    first_day: dt.date,
    last_day: dt.date,
    metric: str = "stars",
    n: int = REPO_ROWS,
) -> DataFrame:
    """The ``n`` repositories with most of ``metric``, and its daily rate to one decimal."""
    if metric not in REPO_METRICS:
        raise ValueError(f"metric is one of {REPO_METRICS}, not {metric!r}")
    per_day = half_even(F.col(metric) / days_in(first_day, last_day), 1)
    return (
        in_period(events, "created_at", first_day, last_day)
        .groupBy("repo_id", "repo_name")
        .agg(
            F.count(F.lit(1)).alias("events"),
            of_type(STAR).alias("stars"),
            of_type(FORK).alias("forks"),
            of_type(PUSH).alias("pushes"),
        )
        .orderBy(F.desc(metric), "repo_id", "repo_name")
        .limit(n)
        .withColumn("per_day", per_day)
    )


def repo_days(
    events: DataFrame, first_day: dt.date, last_day: dt.date, repo_name
) -> DataFrame:
    """Daily series of one repository, given by name (a text or a column)."""
    return (
        in_period(events, "created_at", first_day, last_day)
        .where(F.col("repo_name") == repo_name)
        .groupBy(F.to_date("created_at").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            of_type(STAR).alias("stars"),
            of_type(FORK).alias("forks"),
            of_type(PUSH).alias("pushes"),
        )
        .orderBy("day")
    )


def hour_bounds(hourly: DataFrame) -> DataFrame:
    """First and last hour with data."""
    return hourly.agg(F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))
