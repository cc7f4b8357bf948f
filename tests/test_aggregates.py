import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from codetide.operators import marts
from codetide.operators.features import pane_half_days, repo_activity
from codetide.operators.snapshots import Windows
from codetide.plans import aggregates, reports
from codetide.plans.etl import dated
from codetide.sources import tables

START = dt.date(2025, 1, 1)
DATABASE = "kept"
ODD = Windows(obs_days=3, future_days=2, stride_days=1, min_events=1)


def events_of(spark, days, seed=1, each=40):
    rng = random.Random(seed)
    rows = []
    for day in days:
        for k in range(each):
            at = dt.datetime.combine(START + dt.timedelta(days=day), dt.time(rng.randrange(24), rng.choice((0, 59))))
            rows.append((f"{seed}-{day}-{k}", rng.choice(("PushEvent", "WatchEvent", "ForkEvent")), rng.randrange(9), "a", rng.randrange(6), "r", "Go", 1, None, at))
    columns = "event_id string, event_type string, actor_id bigint, actor_login string, repo_id bigint, repo_name string, language string, commits_count int, action string, created_at timestamp"
    return dated(spark.createDataFrame(rows, columns), "created_at")


@pytest.fixture
def stored(spark):
    tables.ensure_database(spark, DATABASE)
    tables.overwrite_table(events_of(spark, range(30)), f"{DATABASE}.events_parsed")
    yield f"{DATABASE}.events_parsed"
    spark.sql(f"DROP DATABASE {DATABASE} CASCADE")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("windows", [Windows(), ODD, Windows(5, 3, 2, 1)])
def test_panes_of_days(windows):
    """Against the definition: a pane's half days are numbered from the first snapshot."""
    length, anchor = pane_half_days(windows), START + dt.timedelta(days=windows.obs_days)
    for day in (START, START + dt.timedelta(days=4), START + dt.timedelta(days=17)):
        starts, covered = aggregates.pane_days([day], anchor, length)
        assert day in covered and starts == sorted(starts)
        half = lambda d: 2 * (d - anchor).days
        begin = {anchor + dt.timedelta(days=(p * length) // 2): p for p in range(-80, 80)}
        for start in starts:
            own = [p for p in range(-80, 80) if anchor + dt.timedelta(days=(p * length) // 2) == start]
            for p in own:  # all panes of a rewritten partition are computed from all of their days
                assert {anchor + dt.timedelta(days=h // 2) for h in range(p * length, (p + 1) * length)} <= set(covered)
        assert {h // length for h in (half(day), half(day) + 1)} <= {p for s in starts for p in range(begin[s] - 1, begin[s] + 1)}


@pytest.mark.parametrize("windows", [Windows(min_events=1), ODD])
def test_snapshots_from_panes_equal_those_from_events(spark, stored, windows):
    aggregates.update_panes(spark, DATABASE, windows)
    assert rows(aggregates.stored_activity(spark, DATABASE, windows)) == rows(repo_activity(spark.table(stored), windows))
    # A day gets other events, one gets none, and the panes of these days alone are brought up to date.
    changed = [START + dt.timedelta(days=11), START + dt.timedelta(days=20)]
    tables.overwrite_listed(events_of(spark, [11], seed=2), stored, "event_date", changed)
    assert rows(aggregates.stored_activity(spark, DATABASE, windows)) != rows(repo_activity(spark.table(stored), windows))
    aggregates.update_panes(spark, DATABASE, windows, changed)
    assert rows(aggregates.stored_activity(spark, DATABASE, windows)) == rows(repo_activity(spark.table(stored), windows))
    with pytest.raises(ValueError):
        aggregates.stored_activity(spark, DATABASE, Windows(9, 4, 2))


def test_a_load_touches_one_pane(spark, stored):
    """With the events of all other panes unreadable, the pane of a day is still rewritten, and a snapshot reads no events."""
    windows = Windows(min_events=1)
    aggregates.update_panes(spark, DATABASE, windows)
    day = START + dt.timedelta(days=16)
    starts, covered = aggregates.pane_days([day], START + dt.timedelta(days=14), pane_half_days(windows))
    assert len(starts) == 1 and len(covered) == 7
    want = rows(aggregates.stored_activity(spark, DATABASE, windows))
    for file in spark.table(stored).inputFiles():
        if not any(str(d) in file for d in covered):
            Path(file.removeprefix("file://")).write_bytes(b"unreadable")
    aggregates.update_panes(spark, DATABASE, windows, [day])
    assert rows(aggregates.stored_activity(spark, DATABASE, windows)) == want


def test_an_earlier_beginning_counts_the_panes_anew(spark, stored):
    aggregates.update_panes(spark, DATABASE, ODD)
    earlier = events_of(spark, [-3], seed=5)
    tables.overwrite_partitions(earlier, stored)
    aggregates.update_panes(spark, DATABASE, ODD, [START - dt.timedelta(days=3)])
    assert rows(aggregates.stored_activity(spark, DATABASE, ODD)) == rows(repo_activity(spark.table(stored), ODD))


def test_sketches_of_hours_unite(spark, stored):
    aggregates.update_uniques(spark, DATABASE)
    uniques = spark.table(f"{DATABASE}.mart_hourly_uniques")
    first, last = START + dt.timedelta(days=3), START + dt.timedelta(days=9)
    exact, found = reports.kpi(spark.table(stored), first, last).first(), reports.kpi_sketch(uniques, first, last).first()
    assert exact.asDict() == found.asDict()  # few values are counted exactly
    changed = [START + dt.timedelta(days=5), START + dt.timedelta(days=6)]
    tables.overwrite_listed(events_of(spark, [5], seed=9), stored, "event_date", changed)
    aggregates.update_uniques(spark, DATABASE, changed)
    assert rows(spark.table(f"{DATABASE}.mart_hourly_uniques").drop("actor_sketch", "repo_sketch")) == rows(
        dated(marts.uniques_mart(spark.table(stored)), "hour").drop("actor_sketch", "repo_sketch")
    )
    none = reports.kpi_sketch(uniques, dt.date(2020, 1, 1), dt.date(2020, 1, 2)).first()
    assert none.events == none.actors == none.repos == 0


def test_estimates_are_within_their_deviation(spark):
    day = F.timestamp_seconds(F.lit(1735689600) + F.col("id") % 86400)
    many = spark.range(300_000).select(
        day.alias("created_at"), F.lit("PushEvent").alias("event_type"), (F.col("id") % 120_000).alias("actor_id"), (F.col("id") % 7_000).alias("repo_id")
    )
    found = reports.kpi_sketch(marts.uniques_mart(many), dt.date(2025, 1, 1), dt.date(2025, 1, 1)).first()
    assert found.events == 300_000
    assert abs(found.actors / 120_000 - 1) < 3 * marts.SKETCH_DEVIATION and abs(found.repos / 7_000 - 1) < 3 * marts.SKETCH_DEVIATION
