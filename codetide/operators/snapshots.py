"""Snapshots: moments t1 with an observation window before and an outcome window after.

``observation = [t1 - obs_days, t1)`` and ``outcome = [t1, t1 + future_days)``. Every t1 is a
midnight, so window membership is arithmetic on whole days.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Windows:
    """Window lengths and stride in days, and the smallest activity worth a row."""

    obs_days: int = 14
    future_days: int = 7
    stride_days: int = 7
    min_events: int = 3

    def __post_init__(self) -> None:
        if min(self.obs_days, self.future_days, self.stride_days) < 1:
            raise ValueError("windows and stride are at least one day long")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Windows:
        """Defaults, overridden by the ML_* variables that are set."""
        names = {
            "obs_days": "ML_OBS_WINDOW_DAYS",
            "future_days": "ML_FUTURE_WINDOW_DAYS",
            "stride_days": "ML_SNAPSHOT_STRIDE_DAYS",
            "min_events": "ML_MIN_EVENTS",
        }
        return cls(**{field: int(env[name]) for field, name in names.items() if name in env})


def data_bounds(df: DataFrame, column: str = "created_at") -> DataFrame:
    """One row: first and last value of ``column``."""
    return df.agg(F.min(column).alias("first_event"), F.max(column).alias("last_event"))


def day_bounds(events: DataFrame) -> DataFrame:
    """The same to the day. A stored table answers from its partition column alone."""
    return data_bounds(events, "event_date" if "event_date" in events.columns else "created_at")


def snapshot_calendar(bounds: DataFrame, windows: Windows) -> DataFrame:
    """All snapshots a history allows; labelled where the outcome window has closed."""
    first = F.date_add(F.to_date("first_event"), windows.obs_days)
    last = F.to_date("last_event")
    days = F.when(first <= last, F.sequence(first, last, F.make_interval(days=F.lit(windows.stride_days))))
    return bounds.select("last_event", F.explode(days).alias("snapshot_date")).select(
        "snapshot_date",
        F.date_sub("snapshot_date", windows.obs_days).alias("observed_from"),
        F.date_add("snapshot_date", windows.future_days).alias("outcome_until"),
        (F.date_add("snapshot_date", windows.future_days) <= F.to_date("last_event")).alias("label_available"),
    )


@dataclass(frozen=True)
class Calendar:
    """The snapshots that a history allows, as arithmetic on a one-row scalar subquery."""

    windows: Windows
    limits: DataFrame

    def attach(self, df: DataFrame) -> DataFrame:
        """Adds ``calendar``: first snapshot day, last data day, number of the last snapshot.

        Attach once per projection: each reference to a scalar subquery repeats its plan.
        """
        days = self.limits.select(
            F.date_add(F.to_date("first_event"), self.windows.obs_days).alias("first_day"),
            F.to_date("last_event").alias("last_day"),
        )
        last_step = floor_div(F.datediff("last_day", "first_day"), self.windows.stride_days)
        row = days.select(F.struct("first_day", "last_day", last_step.alias("last_step")).alias("c"))
        return df.withColumn("calendar", row.scalar())

    def steps(self, age: Column, per_day: int = 1, outcome: bool = True) -> Column:
        """Array of the snapshot numbers whose windows hold something of this age, or null.

        ``age`` counts from the first snapshot in units of ``1 / per_day`` days, rounded down.
        The numbers are consecutive and follow from the age, so nothing is compared with the
        calendar: there are about (obs_days + future_days) / stride_days, however long the
        history is.
        """
        w = self.windows
        stride = w.stride_days * per_day
        ahead = w.future_days * per_day if outcome else 0
        low = F.greatest(floor_div(age - ahead, stride) + 1, F.lit(0))
        high = F.least(floor_div(age + w.obs_days * per_day, stride), F.col("calendar.last_step"))
        return F.when(low <= high, F.sequence(low, high))

    def snapshot_date(self, step: Column) -> Column:
        return F.date_add(F.col("calendar.first_day"), step * self.windows.stride_days)

    def is_closed(self, snapshot_date: Column) -> Column:
        """Whether the outcome window of the snapshot lies within the data."""
        return F.date_add(snapshot_date, self.windows.future_days) <= F.col("calendar.last_day")


def assign_snapshots(
    events: DataFrame, windows: Windows, bounds: DataFrame | None = None, outcome: bool = True
) -> DataFrame:
    """Each event once per snapshot whose windows hold it.

    Adds ``snapshot_date``, ``label_available`` and ``observed`` (true in the observation
    window, false in the outcome window).
    """
    calendar = Calendar(windows, day_bounds(events) if bounds is None else bounds)
    age = F.datediff(F.to_date("created_at"), F.col("calendar.first_day"))
    t1 = F.col("snapshot_date")
    return (
        calendar.attach(events)
        .withColumn("step", F.explode(calendar.steps(age, outcome=outcome)))
        .withColumn("snapshot_date", calendar.snapshot_date(F.col("step")))
        .select(
            *events.columns,
            "snapshot_date",
            calendar.is_closed(t1).alias("label_available"),
            (F.to_date("created_at") < t1).alias("observed"),
        )
    )


def floor_div(value: Column, divisor: int) -> Column:
    """Integer division rounding down, also for negative values."""
    return ((value - F.pmod(value, F.lit(divisor))) / divisor).cast("int")
