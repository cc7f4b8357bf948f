import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from codetide.operators.cleaning import clean_events
from codetide.plans import etl, incremental
from codetide.plans.etl import MARTS
from codetide.session import materialise
from codetide.sources import tables as tables_
from codetide.streaming import archives as stream
from test_cleaning import NOW, event


def put(folder, name, *events):
    with gzip.open(folder / name, "wt", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(e) for e in events) + "\n")


@pytest.fixture
def load(spark, tmp_path):
    inbox, database = tmp_path / "in", "arrivals"
    inbox.mkdir()
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")

    def run():
        incremental.load_arrivals(spark, str(inbox), database, str(tmp_path / "state"), NOW)
        return sorted((r.event_id, str(r.created_at)) for r in spark.table(f"{database}.events_parsed").collect())

    yield inbox, run
    spark.sql(f"DROP DATABASE {database} CASCADE")


def tables(spark):
    names = ("events_parsed", "mart_repo_activity", "mart_language_activity", "mart_hourly_activity", "events_raw")
    return {n: sorted(map(str, spark.table(f"arrivals.{n}").collect())) for n in names}


def test_a_late_archive_loses_nothing(spark, load):
    inbox, run = load
    (inbox / "notes.txt").write_text("not an archive")
    put(inbox, "2025-03-02-9.json.gz", event("1", at="2025-03-02T09:10:00Z"), event("8", kind="IssuesEvent"), event("9", at="?"))
    assert [i for i, _ in run()] == ["1"]
    put(inbox, "2025-03-01-9.json.gz", event("2", at="2025-03-01T09:00:00Z"), event("3", at="2025-03-01T09:30:00Z"))
    assert [i for i, _ in run()] == ["1", "2", "3"]
    put(inbox, "2025-03-02-10.json.gz", event("4", at="2025-03-02T10:30:00Z"))
    assert [i for i, _ in run()] == ["1", "2", "3", "4"]
    before = tables(spark)
    assert [i for i, _ in run()] == ["1", "2", "3", "4"] and tables(spark) == before


def test_a_line_is_parsed_once(spark):
    """The filters of the cleaning are not moved below the parser; a broken line is a row of nulls, a wrong field alone is null."""
    size = event("3") | {"payload": {"size": "many"}}
    lines = [json.dumps(event("1")), "{broken", "[]", None, json.dumps(event("2", kind="IssuesEvent")), json.dumps(size)]
    landed = materialise(spark.createDataFrame([(x,) for x in lines], "raw string"), "landed")
    raw = incremental.parsed(landed)
    clean = clean_events(raw, NOW)
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert sorted(str(r.id) for r in raw.collect()) == ["1", "2", "3", "None", "None", "None"]
    assert sorted((r.event_id, r.commits_count) for r in clean.collect()) == [("1", clean.where("event_id = '1'").first().commits_count), ("3", 0)]


def test_events_of_new_days_are_deduplicated_once(spark, load, monkeypatch):
    """The days of a load that have no stored events are written as they were cleaned; others meet their stored copies."""
    inbox, run = load
    calls, dedup = [], incremental.dedup_events
    monkeypatch.setattr(incremental, "dedup_events", lambda events: calls.append(1) or dedup(events))
    one = event("1", at="2025-03-02T09:10:00Z")
    put(inbox, "2025-03-02-9.json.gz", one, one | {"created_at": "2025-03-02T09:05:00Z"}, event("2", at="2025-03-03T00:00:00Z"))
    first = [("1", "2025-03-02 09:05:00"), ("2", "2025-03-03 00:00:00")]
    assert run() == first and not calls
    put(inbox, "2025-03-05-9.json.gz", event("3", at="2025-03-05T09:10:00Z"))
    assert run() == [*first, ("3", "2025-03-05 09:10:00")] and not calls
    put(inbox, "2025-03-06-9.json.gz", event("3", at="2025-03-06T09:10:00Z"), event("1", at="2025-03-02T09:00:00Z"))
    assert run() == [("1", "2025-03-02 09:00:00"), first[1], ("3", "2025-03-05 09:10:00")] and calls
    assert sum(r.total_events for r in spark.table("arrivals.mart_repo_activity").collect()) == 3


def test_copies_across_days_leave_the_earliest(spark, load):
    inbox, run = load
    put(inbox, "2025-03-02-9.json.gz", event("1", at="2025-03-02T09:10:00Z"))
    put(inbox, "2025-03-03-9.json.gz", event("2", at="2025-03-03T09:10:00Z"))
    assert len(run()) == 2
    put(inbox, "2025-03-01-9.json.gz", event("1", at="2025-03-01T09:00:00Z"), event("2", at="2025-03-04T09:00:00Z"))
    assert run() == [("1", "2025-03-01 09:00:00"), ("2", "2025-03-03 09:10:00")]
    days = [str(r.event_date) for r in spark.table("arrivals.mart_repo_activity").orderBy("event_date").collect()]
    assert days == ["2025-03-01", "2025-03-03"]


def test_marts_equal_a_load_of_everything(spark, load, tmp_path):
    inbox, run = load
    rows = [event(str(i), at=f"2025-03-0{1 + i % 4}T0{i % 9}:15:00Z") for i in range(1, 40)]
    for k in (2, 0, 3, 1):
        put(inbox, f"2025-03-0{1 + k}-1.json.gz", *[r for i, r in enumerate(rows, 1) if i % 4 == k])
        run()
    parts = tables(spark)
    etl.run_etl(spark, str(inbox), "arrivals", NOW)
    whole = tables(spark)
    assert all(parts[n] == whole[n] for n in parts) and len(parts["events_parsed"]) == 39


def test_same_arrivals_again_and_only_touched_days(spark, load):
    inbox, run = load
    put(inbox, "2025-03-02-9.json.gz", event("1", at="2025-03-02T09:10:00Z"))
    put(inbox, "2025-03-03-9.json.gz", event("2", at="2025-03-03T09:10:00Z"))
    run()
    files = lambda: {f for f in spark.table("arrivals.events_parsed").inputFiles()}
    before, first = tables(spark), files()
    again = spark.createDataFrame([(json.dumps(event("2", at="2025-03-03T09:10:00Z")), "2025-03-03-9.json.gz")], "value string, file_name string")
    incremental.merge_arrivals(again, "arrivals", NOW)
    assert tables(spark) == before
    assert {f for f in first if "2025-03-02" in f} <= files()


def lines_of(spark, name, *events):
    return spark.createDataFrame([(json.dumps(e), name) for e in events], "value string, file_name string")


def spoil(spark, table, kept):
    """Make all files of a table unreadable but those of a path that ``kept`` names."""
    spoiled = 0
    for file in spark.table(table).inputFiles():
        if not any(k in file for k in kept):
            Path(file.removeprefix("file://")).write_bytes(b"unreadable")
            spoiled += 1
    return spoiled


def test_a_load_reads_the_touched_days_only(spark, load):
    """With thirty days stored, a load of one more archive works though all other days are unreadable."""
    run = lambda name, *events: incremental.merge_arrivals(lines_of(spark, name, *events), "arrivals", NOW)
    tables_.ensure_database(spark, "arrivals")
    number = lambda day, k: str(day * incremental.RANGE_IDS + k)
    month = [event(number(d, k), at=f"2025-03-{d:02}T0{k}:10:00Z") for d in range(1, 31) for k in range(4)]
    incremental.merge_arrivals(
        spark.createDataFrame([(json.dumps(e), f"{e['created_at'][:10]}-1.json.gz") for e in month], "value string, file_name string"), "arrivals", NOW
    )
    days, ranges = ["2025-03-07", "2025-03-20"], ["id_range=7", "id_range=20"]
    spoiled = {n: spoil(spark, f"arrivals.{n}", days) for n in ("events_parsed", "events_raw", *MARTS)}
    assert min(k for n, k in spoiled.items() if n != "mart_language_activity") >= 28  # no language is known here
    assert spoil(spark, "arrivals.event_days", [f"{r}/" for r in ranges]) >= 28
    # A new event, a copy of a stored one of the same day, and an earlier copy of one stored on another day.
    new = [event(number(7, 9), at="2025-03-07T09:00:00Z"), event(number(7, 2), at="2025-03-07T05:00:00Z"), event(number(20, 1), at="2025-03-07T08:00:00Z")]
    run("2025-03-07-2.json.gz", *new)
    for name in ("events_parsed", *MARTS):
        spark.catalog.refreshTable(f"arrivals.{name}")
    stored = spark.table("arrivals.events_parsed").where("event_date in (date'2025-03-07', date'2025-03-20')")
    hours = {(r.event_id, str(r.created_at)) for r in stored.collect()}
    want = {(e["id"], e["created_at"].replace("T", " ").removesuffix("Z")) for e in month if e["created_at"][8:10] in ("07", "20")}
    want = (want - {(number(20, 1), "2025-03-20 01:10:00")}) | {(number(7, 9), "2025-03-07 09:00:00"), (number(20, 1), "2025-03-07 08:00:00")}
    assert hours == want
    mart = spark.table("arrivals.mart_hourly_activity").where("event_date in (date'2025-03-07', date'2025-03-20')")
    assert mart.agg(F.sum("event_count")).first()[0] == len(want)


def test_plans_name_the_days(spark, load, capsys):
    inbox, run = load
    put(inbox, "2025-03-02-9.json.gz", event("1", at="2025-03-02T09:10:00Z"))
    run()
    ids = spark.createDataFrame([("1",), ("x",)], "event_id string")
    incremental.indexed_days(spark, "arrivals", ids).explain("formatted")
    assert "PartitionFilters: [id_range#" in capsys.readouterr().out.replace("isnotnull(id_range#", "id_range#")


def test_index_after_a_whole_load(spark, load, tmp_path):
    """A whole load empties the index; the next arrivals build it and find copies of any day."""
    inbox, run = load
    put(inbox, "2025-03-02-9.json.gz", event("1", at="2025-03-02T09:10:00Z"), event("b", at="2025-03-02T09:10:00Z"))
    run()
    etl.run_etl(spark, str(inbox), "arrivals", NOW)
    assert spark.table("arrivals.event_days").isEmpty()
    put(inbox, "2025-03-01-9.json.gz", event("1", at="2025-03-01T09:00:00Z"), event("b", at="2025-03-04T09:00:00Z"), event("n", at="2025-03-04T09:00:00Z"))
    assert run() == [("1", "2025-03-01 09:00:00"), ("b", "2025-03-02 09:10:00"), ("n", "2025-03-04 09:00:00")]
    index = {(r.event_id, str(r.event_date)) for r in spark.table("arrivals.event_days").collect()}
    assert {("1", "2025-03-01"), ("b", "2025-03-02"), ("n", "2025-03-04")} <= index and len(index) == 4


def test_lines_are_landed_as_they_arrive(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    put(inbox, "2025-03-01-9.json.gz", event("1"))
    put(inbox, "other.json.gz", event("2"))
    lines = stream.stream_lines(spark, str(inbox))
    stream.append_available(lines, out, str(tmp_path / "state"), "event_date").awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert [(r.source_file, r.event_hour) for r in rows] == [("2025-03-01-9.json", 9)]
