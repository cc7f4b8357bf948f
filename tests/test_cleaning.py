import datetime as dt
import json

import pytest

from codetide.operators import cleaning
from codetide.schemas import RAW_EVENT

NOW = dt.datetime(2026, 1, 1)


def event(event_id="1", kind="PushEvent", at="2025-03-01T10:00:00Z", repo=(5, "a/b"), actor=(9, "dev"), **payload):
    return {
        "id": event_id, "type": kind, "created_at": at, "payload": payload,
        "repo": {"id": repo[0], "name": repo[1]}, "actor": {"id": actor[0], "login": actor[1]},
    }


def frame(spark, *events):
    lines = [(json.dumps(e),) for e in events]
    return spark.createDataFrame(lines, "line string").selectExpr(
        f"from_json(line, '{RAW_EVENT}') AS e"
    ).select("e.*")


def ids(df, column="event_id"):
    return sorted(row[column] for row in df.collect())


def test_malformed_time_drops_out(spark):
    raw = frame(spark, event("1"), event("2", at="yesterday"), event("3", at=None))
    assert ids(cleaning.clean_events(raw, NOW)) == ["1"]


def test_time_bounds_are_inclusive(spark):
    raw = frame(
        spark,
        event("1", at="2020-01-01T00:00:00Z"), event("2", at="2019-12-31T23:59:59Z"),
        event("3", at="2026-01-01T00:00:00Z"), event("4", at="2026-01-01T00:00:01Z"),
    )
    assert ids(cleaning.clean_events(raw, NOW)) == ["1", "3"]


def test_now_is_the_default_upper_bound(spark):
    raw = frame(spark, event("1"), event("2", at="2190-01-01T00:00:00Z"))
    assert ids(cleaning.clean_events(raw)) == ["1"]


def test_identity_is_required(spark):
    raw = frame(
        spark, event("1"), event(None), event("3", repo=(None, "a/b")), event("4", repo=(5, None)),
        event("5", repo=(5, "")), event("6", actor=(None, None)),
    )
    assert ids(cleaning.clean_events(raw, NOW)) == ["1", "6"]


@pytest.mark.parametrize("size, kept", [(None, True), (10_000, True), (10_001, False)])
def test_push_size(spark, size, kept):
    raw = frame(spark, event(size=size), event("2", kind="ForkEvent", size=size))
    assert ids(cleaning.clean_events(raw, NOW)) == (["1", "2"] if kept else ["2"])


def test_missing_size_counts_no_commits(spark):
    row = cleaning.clean_events(frame(spark, event(size=None)), NOW).first()
    assert row.commits_count == 0


def test_language_prefers_the_pull_request(spark):
    base = {"base": {"repo": {"language": "Go"}}}
    raw = frame(
        spark,
        event("1", forkee={"language": "Rust"}, pull_request=base),
        event("2", forkee={"language": "Rust"}),
        event("3"),
    )
    found = {r.event_id: r.language for r in cleaning.clean_events(raw, NOW).collect()}
    assert found == {"1": "Go", "2": "Rust", "3": "Unknown"}


def test_an_invalid_copy_does_not_displace_a_valid_one(spark):
    raw = frame(spark, event("1", repo=(5, "")), event("1"), event("1", at="2025-03-01T11:00:00Z"))
    rows = cleaning.clean_events(raw, NOW).collect()
    assert [(r.repo_name, r.created_at.hour) for r in rows] == [("a/b", 10)]


def test_the_kept_copy_does_not_depend_on_the_order(spark):
    copies = [event("1", size=n) for n in (3, 1, 2)]
    kept = {
        cleaning.clean_events(frame(spark, *order), NOW).first().commits_count
        for order in (copies, copies[::-1], copies[1:] + copies[:1])
    }
    assert kept == {1}


def test_filters_reach_the_json_scan(spark, tmp_path, capsys):
    (tmp_path / "x.json").write_text(json.dumps(event()))
    raw = spark.read.schema(RAW_EVENT).json(str(tmp_path))
    cleaning.clean_events(raw, NOW).explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line)
    assert "In(type" in pushed and "IsNotNull(id)" in pushed
