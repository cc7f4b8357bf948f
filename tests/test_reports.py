import datetime as dt

import pytest
from pyspark.sql import functions as F

from codetide.functions.numeric import half_even, share
from codetide.operators import marts
from codetide.operators.latest import at_latest, latest_per_key
from codetide.plans import reports, risk_reports
from codetide.schemas import TABLES

EVENTS = (
    "event_id string, event_type string, actor_id long, actor_login string, repo_id long, repo_name string,"
    " language string, commits_count int, action string, created_at timestamp"
)
MONDAY = dt.date(2025, 3, 3)


@pytest.fixture(scope="module")
def events(spark):
    def row(i, kind, actor, repo, name, language, hour, day=3):
        at = dt.datetime(2025, 3, day, hour, 30)
        return (str(i), kind, actor, "x", repo, name, language, 2, None, at)

    return spark.createDataFrame(
        [
            row(1, "PushEvent", 1, 10, "a/old", "Unknown", 10),
            row(2, "PushEvent", 1, 10, "a/new", "Unknown", 10),
            row(3, "WatchEvent", None, 10, "a/new", "Go", 10),
            row(4, "ForkEvent", 2, 11, "b/b", "Go", 11),
            row(5, "WatchEvent", 3, 11, "b/b", "Rust", 23, day=9),
        ],
        EVENTS,
    )


def test_a_renamed_repository_has_one_mart_row_per_name(events):
    mart = marts.repo_mart(events)
    assert mart.where("repo_id = 10").count() == 2
    merged = marts.merge_mart(mart, ["hour", "repo_id"], ["total_events", "total_commits"])
    assert tuple(merged.where("repo_id = 10").select("total_events", "total_commits").first()) == (3, 6)


def test_missing_actors_are_not_counted_as_distinct(events):
    row = marts.hourly_mart(events).where("event_type = 'WatchEvent'").orderBy("hour").first()
    assert (row.event_count, row.unique_users) == (1, 0)


def test_approximate_counts_are_an_option(clean_events):
    exact = marts.hourly_mart(clean_events).agg(F.sum("unique_users")).first()[0]
    sketched = marts.hourly_mart(clean_events, approximate=True).agg(F.sum("unique_users")).first()[0]
    assert sketched == pytest.approx(exact, rel=0.05)
    period = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    both = [reports.kpi(clean_events, *period, flag).first().repos for flag in (False, True)]
    assert both[1] == pytest.approx(both[0], rel=0.1)


def test_hourly_mart_adds_up(events):
    assert marts.hourly_mart(events).agg(F.sum("event_count")).first()[0] == events.count()


def test_period_includes_its_last_day(events):
    one = reports.kpi(events, MONDAY, MONDAY).first()
    assert (one.events, one.actors, one.events_per_day) == (4, 2, 4.0)
    week = reports.kpi(events, MONDAY, MONDAY + dt.timedelta(days=6)).first()
    assert (week.events, week.repos) == (5, 2)


def test_peaks_differ(events):
    hourly = marts.hourly_mart(events)
    assert reports.peak_hour_of_a_type(hourly, MONDAY, MONDAY).first().peak == 2
    assert reports.peak_hour(hourly, MONDAY, MONDAY).first().peak == 3


def test_grid_is_dense(events):
    grid = reports.weekday_hour_grid(marts.hourly_mart(events), MONDAY, MONDAY + dt.timedelta(days=6))
    cells = {(r.dow, r.h): r.events for r in grid.collect()}
    assert len(cells) == 168 and {k: v for k, v in cells.items() if v} == {(1, 10): 3, (1, 11): 1, (7, 23): 1}


def test_language_trend_of_given_languages(events):
    week = (MONDAY, MONDAY + dt.timedelta(days=6))
    rows = reports.language_trend(events, *week, ["Rust"]).collect()
    assert [(str(r.day), r.events, r.stars) for r in rows] == [("2025-03-09", 1, 1)]
    assert reports.language_trend(events, *week).count() == 2


def test_one_repository(events):
    rows = reports.repo_days(events, MONDAY, MONDAY, "a/new").collect()
    assert [(r.events, r.stars, r.pushes) for r in rows] == [(2, 1, 1)]
    with pytest.raises(ValueError):
        reports.top_repos(events, MONDAY, MONDAY, "commits")


def test_rounding_and_shares(spark):
    df = spark.sql("select explode(array(0.25D, 0.35D, 0.05D, 0.45D, 0.75D)) x")
    assert [r.r for r in df.select(half_even(F.col("x"), 1).alias("r")).collect()] == [0.2, 0.4, 0.0, 0.4, 0.8]
    assert spark.range(1).select(share(F.lit(1), F.lit(0))).first()[0] == 0.0


def test_latest_versions(spark, capsys):
    df = spark.sql(
        "select * from values (1, 1, 'old'), (1, 2, 'new'), (2, 1, 'only') as t(key, version, text)"
    )
    found = latest_per_key(df, ["key"], F.desc("version"))
    assert {(r.key, r.text) for r in found.collect()} == {(1, "new"), (2, "only")}
    latest_per_key(df, ["key"], F.desc("version")).explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert [r.text for r in at_latest(df, "version").collect()] == ["new"]


def test_reports_on_empty_predictions(spark):
    empty = spark.createDataFrame(
        [],
        "snapshot_date date, repo_id long, repo_name string, language string, probability double,"
        " prediction int, label int, model string, trained_at timestamp",
    )
    row = risk_reports.summary(empty).first()
    assert (row.total, row.flagged_share) == (0, 0.0)
    assert risk_reports.effective_threshold(empty).first().threshold == 0.5
    assert risk_reports.probability_histogram(empty).count() == 0


def test_risk_change_shuffles_once(spark):
    stored = spark.createDataFrame([], TABLES["ml_repo_predictions"].schema)
    plan = risk_reports.risk_change(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
