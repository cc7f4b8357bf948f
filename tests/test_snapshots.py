"""Windows, features and labels against a direct computation in plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from codetide.operators import features
from codetide.operators.snapshots import Windows, assign_snapshots, data_bounds, day_bounds, snapshot_calendar

SCHEMA = (
    "event_id string, event_type string, actor_id long, repo_id long, repo_name string,"
    " language string, commits_count int, created_at timestamp"
)
KINDS = ("PushEvent", "WatchEvent", "ForkEvent", "PullRequestEvent")
START = dt.datetime(2025, 3, 3, 7, 30)


def some_events(days, count, seed):
    """Repository 1 has a third of all events, and half of those are one actor's."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        repo = 1 if rng.random() < 0.33 else rng.randint(2, 12)
        actor = 7 if repo == 1 and rng.random() < 0.5 else rng.choice([None, 1, 2, 3, 4])
        minutes = 0 if i == 0 else rng.randrange(days * 24 * 60) // (30 if repo == 5 else 1)
        name = f"org/{repo}{rng.choice('ab')}"
        at = START + dt.timedelta(minutes=minutes)
        rows.append((f"e{i:05}", rng.choice(KINDS), actor, repo, name, rng.choice(["Go", "Unknown"]),
                     rng.randint(0, 9), at))
    return rows


def brute_force(rows, w):
    first, last = min(r[7] for r in rows), max(r[7] for r in rows)
    day = dt.timedelta(days=1)
    t1 = (first + w.obs_days * day).replace(hour=0, minute=0, second=0, microsecond=0)
    out = {}
    while t1 <= last:
        start, end = t1 - w.obs_days * day, t1 + w.future_days * day
        middle = start + (t1 - start) / 2
        by_repo, future = defaultdict(list), defaultdict(int)
        for r in rows:
            if start <= r[7] < t1:
                by_repo[r[3]].append(r)
            elif t1 <= r[7] < end:
                future[r[3]] += 1
        for repo, seen in by_repo.items():
            if len(seen) < w.min_events:
                continue
            times = [r[7] for r in seen]
            per_actor = defaultdict(int)
            for r in seen:
                per_actor[r[2]] += 1
            newest = max((r[7], r[4], r[5]) for r in seen)
            hour = lambda x: int(x.replace(tzinfo=dt.timezone.utc).timestamp()) // 3600
            out[t1.date(), repo] = {
                "repo_name": newest[1],
                "language": newest[2],
                "events_total": len(seen),
                "pushes": sum(r[1] == KINDS[0] for r in seen),
                "commits_total": sum(r[6] for r in seen if r[1] == KINDS[0]),
                "stars": sum(r[1] == KINDS[1] for r in seen),
                "forks": sum(r[1] == KINDS[2] for r in seen),
                "prs": sum(r[1] == KINDS[3] for r in seen),
                "actors": len({r[2] for r in seen} - {None}),
                "active_days": len({t.date() for t in times}),
                "activity_span_hours": hour(max(times)) - hour(min(times)) + 1,
                "hours_since_last": hour(t1) - hour(max(times)),
                "events_first_half": sum(t < middle for t in times),
                "events_second_half": sum(t >= middle for t in times),
                "top_actor_events": max(per_actor.values()),
                "future_events": future[repo] if end <= last else None,
                "label_available": end <= last,
            }
        t1 += w.stride_days * day
    return out


@pytest.mark.parametrize(
    "windows, days",
    [
        (Windows(), 45),
        (Windows(14, 7, 1), 40),
        (Windows(15, 7, 7), 45),
        (Windows(9, 2, 4, 1), 40),
        (Windows(70, 7, 14), 150),
        (Windows(128, 64, 64), 300),
        (Windows(121, 1, 11), 260),
        (Windows(7, 21, 7), 60),
    ],
)
def test_features_equal_brute_force(spark, windows, days):
    rows = some_events(days, 900, seed=days + windows.obs_days)
    events = spark.createDataFrame(rows, SCHEMA)
    found = {
        (r.snapshot_date, r.repo_id): {k: v for k, v in r.asDict().items() if k not in ("snapshot_date", "repo_id")}
        for r in features.repo_activity(events, windows).collect()
    }
    assert found == brute_force(rows, windows)


def outcome_counts(events, windows):
    """Events per repository in the outcome window of each snapshot that has closed."""
    placed = assign_snapshots(events.select("repo_id", "created_at"), windows, day_bounds(events))
    return (
        placed.where(~F.col("observed") & F.col("label_available"))
        .groupBy("snapshot_date", "repo_id")
        .agg(F.count(F.lit(1)).alias("future_events"))
    )


def test_one_pass_equals_the_joined_parts(clean_events):
    w = Windows()
    rows = features.repo_activity(clean_events, w)
    keys = ["snapshot_date", "repo_id"]
    joined = (
        rows.select(*keys, "top_actor_events", "events_total", "future_events", "label_available")
        .join(features.top_actor(clean_events, w).withColumnRenamed("top_actor_events", "top"), keys, "left")
        .join(outcome_counts(clean_events, w).withColumnRenamed("future_events", "n"), keys, "left")
    )
    wrong = joined.where(
        "top <> top_actor_events or actor_events_total <> events_total"
        " or (label_available and coalesce(n, 0) <> future_events) or (not label_available and n is not null)"
    )
    assert rows.count() > 0 and wrong.count() == 0


def test_invariants(clean_events):
    rows = features.snapshot_rows(clean_events, Windows())
    assert rows.where("events_first_half + events_second_half <> events_total").count() == 0
    assert rows.where("top_actor_share > 1 or active_days > 14 or events_total < 3").count() == 0
    assert rows.groupBy("snapshot_date", "repo_id").count().where("count > 1").count() == 0


def test_boundary_instants(spark):
    t1 = dt.datetime(2025, 1, 15)
    at = [
        dt.datetime(2025, 1, 1), t1 - dt.timedelta(days=7), t1 - dt.timedelta(microseconds=1), t1,
        t1 + dt.timedelta(days=7) - dt.timedelta(microseconds=1), t1 + dt.timedelta(days=7),
    ]
    events = spark.createDataFrame([(str(i), t) for i, t in enumerate(at)], "event_id string, created_at timestamp")
    placed = assign_snapshots(events, Windows()).where(F.col("snapshot_date") == t1.date())
    assert {(r.event_id, r.observed) for r in placed.collect()} == {
        ("0", True), ("1", True), ("2", True), ("3", False), ("4", False),
    }


def test_assignment_equals_a_range_join(spark):
    rows = some_events(40, 300, seed=3)
    events = spark.createDataFrame(rows, SCHEMA).select("event_id", "created_at")
    for w in (Windows(), Windows(10, 3, 4), Windows(3, 5, 7)):
        placed = assign_snapshots(events, w)
        calendar = snapshot_calendar(data_bounds(events), w)
        joined = events.join(
            calendar,
            (F.col("created_at") >= F.col("observed_from").cast("timestamp"))
            & (F.col("created_at") < F.col("outcome_until").cast("timestamp")),
        )
        keys = ["event_id", "snapshot_date", "label_available"]
        ours, theirs = placed.select(*keys), joined.select(*keys)
        assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0


def test_short_history_has_no_snapshot(spark):
    events = spark.createDataFrame(some_events(3, 50, seed=1), SCHEMA)
    assert features.repo_activity(events, Windows()).count() == 0
    assert snapshot_calendar(data_bounds(events), Windows()).count() == 0


def test_windows_from_the_environment():
    env = {"ML_OBS_WINDOW_DAYS": "10", "ML_MIN_EVENTS": "5"}
    assert Windows.from_env(env) == Windows(10, 7, 7, 5)
    with pytest.raises(ValueError):
        Windows(obs_days=0)


def test_hours_are_counted_by_boundaries(spark):
    from codetide.functions.time import hours_crossed, iso_weekday

    row = spark.sql(
        "select timestamp'2025-01-05 10:59:00' a, timestamp'2025-01-05 11:01:00' b,"
        " timestamp'2025-01-06 00:00:00' m"
    ).select(
        hours_crossed(F.col("a"), F.col("b")).alias("h"), iso_weekday(F.col("a")).alias("sunday"),
        iso_weekday(F.col("m")).alias("monday"),
    ).first()
    assert (row.h, row.sunday, row.monday) == (1, 7, 1)


def test_events_are_hash_aggregated_before_the_copies(clean_events):
    plan = features.repo_activity(clean_events, Windows())._jdf.queryExecution().executedPlan().toString()
    first_generate = plan.index("Generate explode")
    below = plan[first_generate:]
    assert "HashAggregate" in below and "SortAggregate" not in below


def test_plans_hash_events_before_they_combine(clean_events):
    """No sort of events for the latest attributes; events are counted before they are copied to snapshots."""
    plan = features.repo_latest_attributes(clean_events)._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan")
    nearest = max(plan.rfind(x, 0, scan) for x in ("HashAggregate", "SortAggregate"))
    assert plan[nearest:].startswith("HashAggregate")
    plan = features.top_actor(clean_events, Windows())._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.rindex("HashAggregate", 0, plan.index("FileScan"))
