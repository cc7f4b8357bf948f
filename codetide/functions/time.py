"""Calendar expressions, all in the session time zone (UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two instants: 10:59 to 11:01 is one."""
    return _epoch_hour(end) - _epoch_hour(start)


def _epoch_hour(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / 3600).cast("bigint")


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(ts) + 1


def in_period(df: DataFrame, column: str, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Rows of the calendar days ``first_day`` to ``last_day``, both included.

    A table laid out by ``event_date`` is also filtered on it, which prunes its directories.
    """
    start = dt.datetime.combine(first_day, dt.time())
    end = dt.datetime.combine(last_day + dt.timedelta(days=1), dt.time())
    ts = F.col(column)
    kept = df.where((ts >= instant(start)) & (ts < instant(end)))
    if "event_date" in df.columns:
        kept = kept.where(F.col("event_date").between(F.lit(first_day), F.lit(last_day)))
    return kept


def instant(value: dt.datetime) -> Column:
    """A timestamp literal read in the session time zone, whatever the driver's own zone is."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def days_in(first_day: dt.date, last_day: dt.date) -> int:
    return max((last_day - first_day).days + 1, 1)
