"""Repository features per snapshot, outcome labels, and the training data sets."""

from __future__ import annotations

from math import ceil, gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetide.functions.numeric import guarded_ratio
from codetide.functions.time import hours_crossed
from codetide.operators.snapshots import (
    Calendar,
    Windows,
    assign_snapshots,
    day_bounds,
    floor_div,
)
from codetide.schemas import FORK, PULL_REQUEST, PUSH, STAR

# Columns that enter the model, in order.
NUMERIC_FEATURES = (
    "events_total", "pushes", "commits_total", "stars", "forks", "prs",
    "actors", "active_days", "activity_span_hours", "hours_since_last",
    "events_first_half", "events_second_half",
    "top_actor_share", "events_per_active_day", "commits_per_push",
    "trend_ratio", "events_per_actor",
)
CATEGORICAL_FEATURES = ("language",)

HALF_DAY_SECONDS = 43_200

# Days of an observation window are marked in 64-bit words, of which this many bits are used.
DAYS_PER_WORD = 60

EVENT_COLUMNS = (
    "event_type", "actor_id", "repo_id", "repo_name", "language", "commits_count", "created_at",
)
COUNTS = ("events", "pushes", "commits", "stars", "forks", "prs")


def _last_attributes() -> Column:
    """Name and language at the last event; of events at one instant, the greatest pair."""
    return F.max(F.struct("created_at", "repo_name", "language"))


def repo_latest_attributes(events: DataFrame) -> DataFrame:
    """Name and language of each repository at its last event.

    The first level is of fixed width, so events are hashed and combined before the shuffle; the maximum of the
    whole triple is taken over the few names and languages that are left.
    """
    spans = events.groupBy("repo_id", "repo_name", "language").agg(F.max("created_at").alias("created_at"))
    return spans.groupBy("repo_id").agg(_last_attributes().alias("last")).select(
        "repo_id", "last.repo_name", "last.language"
    )


def repo_activity(events: DataFrame, windows: Windows, bounds: DataFrame | None = None) -> DataFrame:
    """All window measures and the outcome count of each repository and snapshot, in one pass.

    The windows of all snapshots are unions of panes, the longest spans that every window
    boundary respects (a week for 14, 7 and 7 days). Three levels of aggregation:

    1. events to (pane, repository, actor). Every buffer is of fixed width, so this level,
       the only one that sees events, is a hash aggregate that combines before its shuffle.
    2. panes, copied to their snapshots, to (snapshot, repository, actor).
    3. (snapshot, repository). Distinct actors, the largest actor and distinct days are a
       count, a maximum and a bitwise or over level 2.

    A repository with very many events is spread over its actors in 1 and 2, and an actor
    with very many events is combined before each shuffle. No join, no exact distinct count.
    """
    limits = day_bounds(events) if bounds is None else bounds
    return activity_from_panes(actor_panes(events, windows, limits), windows, limits)


def actor_panes(events: DataFrame, windows: Windows, bounds: DataFrame) -> DataFrame:
    """Level 1, which can be stored: a pane's rows depend on the events of the pane and on the first day of the history only."""
    return _actor_panes(events.select(*EVENT_COLUMNS), Calendar(windows, bounds))


def activity_from_panes(panes: DataFrame, windows: Windows, bounds: DataFrame) -> DataFrame:
    """Levels 2 and 3 over panes, be they just computed or stored."""
    calendar = Calendar(windows, bounds)
    return _per_repo(_per_actor(panes, calendar), calendar).where(
        F.col("events_total") >= windows.min_events
    )


def pane_half_days(windows: Windows) -> int:
    """Length of a pane in half days: the middle of an odd observation window is a noon."""
    length = gcd(2 * windows.stride_days, 2 * windows.future_days, windows.obs_days)
    # A pane touches at most length // 2 + 1 days, which have to fit into one word.
    return max(n for n in range(1, length + 1) if length % n == 0 and n // 2 < DAYS_PER_WORD)


def _actor_panes(events: DataFrame, calendar: Calendar) -> DataFrame:
    """Level 1. ``days`` marks the days with events, counted from the day the pane starts in."""
    kind, at = F.col("event_type"), F.col("created_at")
    first_day = F.col("calendar.first_day")
    seconds = F.unix_seconds(at) - F.unix_seconds(first_day.cast("timestamp"))
    length = pane_half_days(calendar.windows)
    pane = floor_div(F.floor(seconds / HALF_DAY_SECONDS).cast("int"), length)
    day = F.datediff(F.to_date(at), first_day) - _start_day(pane, length)
    return (
        calendar.attach(events)
        .withColumns({"pane": pane, "day": day})
        .groupBy("pane", "repo_id", "actor_id", "repo_name", "language")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(kind == PUSH).alias("pushes"),
            F.sum(F.when(kind == PUSH, F.col("commits_count")).otherwise(0)).alias("commits"),
            F.count_if(kind == STAR).alias("stars"),
            F.count_if(kind == FORK).alias("forks"),
            F.count_if(kind == PULL_REQUEST).alias("prs"),
            F.min(at).alias("first_at"),
            F.max(at).alias("created_at"),
            F.bit_or(_shift_left(F.lit(1).cast("bigint"), F.col("day"))).alias("days"),
        )
    )


def _start_day(pane: Column, length: int) -> Column:
    return floor_div(pane * length, 2)


def _shift_left(bits: Column, places: Column) -> Column:
    return F.call_function("shiftleft", bits, places)


def _per_actor(panes: DataFrame, calendar: Calendar) -> DataFrame:
    """Level 2: each pane in its snapshots, added up per actor."""
    windows = calendar.windows
    length = pane_half_days(windows)
    start = F.col("pane") * length
    placed = calendar.attach(panes).withColumn("step", F.explode(calendar.steps(start, per_day=2)))

    t1 = F.col("step") * (2 * windows.stride_days)
    seen = start < t1
    first_half = start < t1 - windows.obs_days
    position = _start_day(F.col("pane"), length) - F.col("step") * windows.stride_days + windows.obs_days

    def total(column: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    def day_word(word: int) -> Column:
        place = position - word * DAYS_PER_WORD
        inside = _shift_left(F.col("days"), place).bitwiseAND(F.lit((1 << DAYS_PER_WORD) - 1))
        carried = F.call_function("shiftright", F.col("days"), -place)
        bits = F.when(seen & place.between(0, DAYS_PER_WORD - 1), inside).when(
            seen & place.between(1 - DAYS_PER_WORD, -1), carried
        )
        return F.bit_or(F.coalesce(bits, F.lit(0).cast("bigint")))

    return placed.groupBy("step", "repo_id", "actor_id").agg(
        *[total(c, seen).alias(c) for c in COUNTS],
        total("events", first_half).alias("first_half"),
        total("events", seen & ~first_half).alias("second_half"),
        total("events", ~seen).alias("future"),
        F.min(F.when(seen, F.col("first_at"))).alias("first_at"),
        F.max(F.when(seen, F.struct("created_at", "repo_name", "language"))).alias("last"),
        *[day_word(w).alias(f"days_{w}") for w in range(_words(windows))],
    )


def _words(windows: Windows) -> int:
    return ceil(windows.obs_days / DAYS_PER_WORD)


def _per_repo(per_actor: DataFrame, calendar: Calendar) -> DataFrame:
    """Level 3."""
    words = [F.bit_count(F.bit_or(f"days_{w}")) for w in range(_words(calendar.windows))]
    active_days = sum(words[1:], words[0])
    grouped = per_actor.groupBy("step", "repo_id").agg(
        F.max("last").alias("last"),
        F.sum("events").alias("events_total"),
        F.sum("pushes").alias("pushes"),
        F.sum("commits").alias("commits_total"),
        F.sum("stars").alias("stars"),
        F.sum("forks").alias("forks"),
        F.sum("prs").alias("prs"),
        F.count_if(F.col("actor_id").isNotNull() & (F.col("events") > 0)).alias("actors"),
        active_days.cast("bigint").alias("active_days"),
        F.min("first_at").alias("first_at"),
        F.sum("first_half").alias("events_first_half"),
        F.sum("second_half").alias("events_second_half"),
        F.max("events").alias("top_actor_events"),
        F.sum("future").alias("future"),
    )
    last_at, t1 = F.col("last.created_at"), F.col("snapshot_date")
    closed = F.col("label_available")
    dated = calendar.attach(grouped).withColumn("snapshot_date", calendar.snapshot_date(F.col("step")))
    return dated.withColumn("label_available", calendar.is_closed(t1)).select(
        "snapshot_date",
        "repo_id",
        "last.repo_name",
        "last.language",
        "events_total",
        "pushes",
        "commits_total",
        "stars",
        "forks",
        "prs",
        "actors",
        "active_days",
        (hours_crossed(F.col("first_at"), last_at) + 1).alias("activity_span_hours"),
        hours_crossed(last_at, t1.cast("timestamp")).alias("hours_since_last"),
        "events_first_half",
        "events_second_half",
        "top_actor_events",
        F.when(closed, F.col("future")).alias("future_events"),
        "label_available",
    )


def top_actor(events: DataFrame, windows: Windows, bounds: DataFrame | None = None) -> DataFrame:
    """Events of the most active actor and of all actors, per snapshot and repository.

    Events without an actor count together as one.
    """
    limits = day_bounds(events) if bounds is None else bounds
    # Counted per day first, so that what is copied to the snapshots is no longer events.
    daily = events.groupBy(F.to_date("created_at").alias("created_at"), "repo_id", "actor_id").agg(F.count(F.lit(1)).alias("n"))
    placed = assign_snapshots(daily, windows, limits, outcome=False)
    per_actor = placed.groupBy("snapshot_date", "repo_id", "actor_id").agg(F.sum("n").alias("n"))
    return per_actor.groupBy("snapshot_date", "repo_id").agg(
        F.max("n").alias("top_actor_events"), F.sum("n").alias("actor_events_total")
    )


def with_ratios(features: DataFrame) -> DataFrame:
    total = F.col("events_total")
    return features.withColumns(
        {
            "top_actor_share": guarded_ratio(F.col("top_actor_events"), total),
            "events_per_active_day": guarded_ratio(total, F.col("active_days")),
            "commits_per_push": guarded_ratio(F.col("commits_total"), F.col("pushes")),
            "trend_ratio": (F.col("events_second_half") + 1) / (F.col("events_first_half") + 1),
            "events_per_actor": guarded_ratio(total, F.col("actors")),
        }
    )


def with_label(features: DataFrame) -> DataFrame:
    """``abandoned`` = 1 when the outcome window has closed without an event, else 0."""
    silent = F.col("label_available") & (F.col("future_events") == 0)
    return features.withColumn("abandoned", F.when(silent, 1).otherwise(0))


def snapshot_rows(events: DataFrame, windows: Windows, bounds: DataFrame | None = None) -> DataFrame:
    """Features, ratios and label of every repository in every snapshot."""
    return with_label(with_ratios(repo_activity(events, windows, bounds)))


def labelled(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("label_available"))


def unlabelled(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("label_available"))


def build_dataset(
    events: DataFrame, windows: Windows, bounds: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows to train on and rows to predict, both lazy."""
    rows = snapshot_rows(events, windows, bounds)
    return labelled(rows), unlabelled(rows)


def abandoned_repos(events: DataFrame, windows: Windows, bounds: DataFrame | None = None) -> DataFrame:
    """Repositories observed in a closed snapshot and silent in its outcome window."""
    silent = labelled(repo_activity(events, windows, bounds)).where(F.col("future_events") == 0)
    return silent.select("snapshot_date", "repo_id", "repo_name")


def dataset_summary(rows: DataFrame) -> DataFrame:
    """One row: size, distinct repositories and share of abandoned rows."""
    return rows.agg(
        F.count(F.lit(1)).alias("dataset_rows"),
        F.count_distinct("repo_id").alias("repos"),
        F.avg("abandoned").alias("abandoned_share"),
    )
