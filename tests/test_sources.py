import datetime as dt
import gzip
import json
import re

import pytest
from pyspark.sql import functions as F

from codetide.plans import etl
from codetide.session import materialise
from codetide.sources import archives, clickstream, manifest, tables
from codetide.streaming import archives as streaming
from conftest import SF_DIR
from test_cleaning import NOW, event


@pytest.fixture
def folder(tmp_path):
    """Three good archives, one badly named, with a blank and a broken line."""

    def put(name, *lines):
        with gzip.open(tmp_path / name, "wt", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")

    one, two = json.dumps(event("1")), json.dumps(event("2", at="2025-03-01T23:10:00Z"))
    put("2025-03-01-9.json.gz", one, "", " \u3000 ", "\t " + two + "\xa0 ")
    put("2025-03-01-23.json.gz", "{broken", json.dumps(event("3", kind="WatchEvent")))
    put("2025-03-02-0.json.gz", one)
    put("backup.json.gz", json.dumps(event("4")))
    return tmp_path


@pytest.fixture
def database(spark, request):
    name = "db_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    tables.ensure_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_landing_keeps_whole_lines_of_well_named_files(spark, folder):
    rows = archives.land_lines(archives.read_lines(spark, str(folder))).collect()
    assert sorted((str(r.event_date), r.event_hour, r.source_file) for r in rows) == [
        ("2025-03-01", 9, "2025-03-01-9.json"), ("2025-03-01", 9, "2025-03-01-9.json"),
        ("2025-03-01", 23, "2025-03-01-23.json"), ("2025-03-01", 23, "2025-03-01-23.json"),
        ("2025-03-02", 0, "2025-03-02-0.json"),
    ]
    assert "{broken" in {r.raw for r in rows}
    assert all(r.raw == r.raw.strip() for r in rows)


def test_landing_strips_and_names_as_the_pattern_says(spark):
    white = archives.WHITE_SPACE
    values = ["a", "", None, white, "\u3000", f"{white}b c{white}", "\u200bx", "d\u00a0", "\ue000", "\U0001f600"]
    names = ["2025-03-01-9.json.gz", "2025-03-01-23.json.gz", "2025-03-01-9.json.gz\n", "2025-03-01-123.json.gz", "x2025-03-01-9.json.gz", None]
    lines = materialise(spark.createDataFrame([(v, n) for v in values for n in names], "value string, file_name string"), "lines")
    found = sorted((str(r.event_date), r.event_hour, r.source_file, r.raw) for r in archives.land_lines(lines).collect())
    stripped = [v.strip(white) for v in values if v and v.strip(white)]
    sources = [("2025-03-01", 9, "2025-03-01-9.json"), ("2025-03-01", 23, "2025-03-01-23.json"), ("2025-03-01", 9, "2025-03-01-9.json\n")]
    assert found == sorted((*s, v) for s in sources for v in stripped)


def test_mapping_is_short_enough_to_be_compiled(spark):
    """The JVM never compiles a method of more than 8,000 bytes."""
    clicks = clickstream.read_clickstream(spark, SF_DIR)
    for frame in (clickstream.raw_events(clicks), archives.land_lines(clickstream.untidy_lines(clicks))):
        code = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
        assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) <= 8000


def test_a_broken_line_reads_as_nulls(spark, folder):
    raw = archives.read_archives(spark, str(folder / "2025-03-01-23.json.gz"))
    assert sorted(str(r.id) for r in raw.collect()) == ["3", "None"]


def test_incremental_landing(spark, folder, database, tmp_path):
    state = str(tmp_path / "state")
    land = lambda: streaming.land_new_archives(spark, str(folder), database, state)
    counts = lambda: {r.source_file: r.lines for r in archives.landed_counts(spark.table(f"{database}.events_raw")).collect()}
    land()
    first = {"2025-03-01-9.json": 2, "2025-03-01-23.json": 2, "2025-03-02-0.json": 1}
    assert counts() == first
    land()
    assert counts() == first
    with gzip.open(folder / "2025-03-02-1.json.gz", "wt") as f:
        f.write(json.dumps(event("5")) + "\n")
    land()
    assert counts() == first | {"2025-03-02-1.json": 1}


def test_both_ways_of_reading_give_the_same_lines(spark, folder):
    files = spark.read.format("binaryFile").load(str(folder))
    whole = archives.whole_archives(files.select("path", "content"))
    assert sorted(map(str, archives.land_lines(whole).collect())) == sorted(map(str, archives.land_lines(archives.read_lines(spark, str(folder))).collect()))


def test_faulty_archives_are_set_aside(spark, folder, database, tmp_path):
    """Cut, damaged inside, damaged checksum, no archive at all; two members are no fault, and an empty file is a missing hour."""
    text = "".join(json.dumps(event(str(i))) + "\n" for i in range(3000)).encode()
    packed = gzip.compress(text)
    damaged = bytearray(packed)
    damaged[len(packed) // 2] ^= 0xFF
    files = {
        "2025-03-05-0": packed[:-9], "2025-03-05-1": packed[: len(packed) // 2], "2025-03-05-2": bytes(damaged),
        "2025-03-05-3": packed[:-8] + b"\0" * 8, "2025-03-05-4": b"no archive", "2025-03-05-5": b"", "2025-03-05-6": packed + packed,
    }
    for name, content in files.items():
        (folder / f"{name}.json.gz").write_bytes(content)
    for _ in range(2):
        streaming.land_new_archives(spark, str(folder), database, str(tmp_path / "state"))
    aside = {r.source_file: r.reason for r in spark.table(f"{database}.archives_quarantined").collect()}
    assert set(aside) == {f"2025-03-05-{k}.json" for k in range(5)}  # an empty file has no row in any scan
    assert aside["2025-03-05-0.json"] == aside["2025-03-05-1.json"] == "truncated"
    assert aside["2025-03-05-2.json"] in ("corrupt", "truncated") and aside["2025-03-05-3.json"] == aside["2025-03-05-4.json"] == "corrupt"
    landed = spark.table(f"{database}.events_raw")
    assert {r.source_file: r.lines for r in archives.landed_counts(landed.where("event_date = date'2025-03-05'")).collect()} == {"2025-03-05-6.json": 6000}
    hours = manifest.hours_of_days(spark.sql("select date'2025-03-05' first_day, date'2025-03-05' last_day"))
    assert {r.event_hour for r in manifest.missing_hours(hours, landed).collect()} == set(range(24)) - {6}


def test_manifests(spark):
    period = spark.sql("select date'2025-02-28' first_day, date'2025-03-01' last_day")
    names = [r.file_name for r in manifest.hours_of_days(period).orderBy("event_date", "event_hour").collect()]
    assert len(names) == 48 and names[0] == "2025-02-28-0.json.gz" and names[-1] == "2025-03-01-23.json.gz"
    start = spark.sql("select date'2025-02-28' first_day, 22 start_hour, 4 n_hours")
    names = [r.file_name for r in manifest.hours_from(start).collect()]
    assert names == [
        "2025-02-28-22.json.gz", "2025-02-28-23.json.gz", "2025-03-01-0.json.gz", "2025-03-01-1.json.gz",
    ]
    backwards = spark.sql("select date'2025-03-02' first_day, date'2025-03-01' last_day")
    assert manifest.hours_of_days(backwards).count() == 0


def test_missing_hours(spark):
    period = spark.sql("select date'2025-03-01' first_day, date'2025-03-01' last_day")
    landed = spark.range(21).selectExpr("'2025-03-01-' || id || '.json' as source_file")
    hours = manifest.hours_of_days(period)
    assert [r.event_hour for r in manifest.missing_hours(hours, landed).orderBy("event_hour").collect()] == [21, 22, 23]
    assert tuple(manifest.backfill_progress(hours, landed).first()) == (3, 21)


def test_etl_from_archives_is_idempotent(spark, folder, database):
    names = ("events_parsed", "mart_language_activity", "mart_repo_activity", "mart_hourly_activity")
    sizes = []
    for _ in range(2):
        etl.run_etl(spark, str(folder / "*.json.gz"), database, NOW)
        sizes.append([spark.table(f"{database}.{n}").count() for n in names])
    assert sizes[0] == sizes[1] and sizes[0][0] == 4
    hourly = spark.table(f"{database}.mart_hourly_activity")
    assert hourly.agg(F.sum("event_count")).first()[0] == sizes[0][0]


def test_stored_events_are_pruned_by_period(spark, folder, database, capsys):
    from codetide.functions.time import in_period

    etl.run_etl(spark, str(folder / "*.json.gz"), database, NOW)
    events = spark.table(f"{database}.events_parsed")
    day = dt.date(2025, 3, 1)
    in_period(events, "created_at", day, day).select("repo_id").explain("formatted")
    out = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(event_date" in out
    assert "ReadSchema: struct<repo_id:bigint,created_at:timestamp>" in out


def test_a_look_up_of_one_repository_skips_pages(spark, database):
    """Of a day with 200,000 events the scan gives a tenth at most for one repository out of 1,000."""
    from codetide.plans import reports

    table = f"{database}.events_parsed"
    day = dt.date(2025, 3, 1)
    rows = spark.range(200_000).selectExpr(
        "string(id) event_id", "'PushEvent' event_type", "id % 97 actor_id", "'a' actor_login", "pmod(xxhash64(id), 1000) repo_id",
        "'org/r' || pmod(xxhash64(id), 1000) repo_name", "'Go' language", "1 commits_count", "string(null) action",
        "timestamp_seconds(1740787200 + id % 86400) created_at", "date'2025-03-01' event_date",
    )
    tables.overwrite_table(rows.coalesce(1), table)
    found = reports.repo_days(spark.table(table), day, day, "org/r500")
    frame = found.select("*")
    want = rows.where("repo_name = 'org/r500'").count()
    plan = frame._jdf.queryExecution().executedPlan()
    frame.collect()
    scans = plan.collectLeaves() if plan.nodeName() != "AdaptiveSparkPlan" else plan.executedPlan().collectLeaves()
    leaves = [scans.apply(i) for i in range(scans.size())]
    while any(x.nodeName().endswith("QueryStage") for x in leaves):
        inner = [x.plan().collectLeaves() if x.nodeName().endswith("QueryStage") else None for x in leaves]
        leaves = [y.apply(i) for y in inner if y for i in range(y.size())] + [x for x, y in zip(leaves, inner, strict=True) if y is None]
    (scan,) = [x for x in leaves if x.nodeName().startswith("Scan")]
    assert want <= scan.metrics().apply("numOutputRows").value() <= 20_000


def test_sinks(spark, database):
    name = f"{database}.mart_hourly_activity"
    rows = spark.sql(
        "select timestamp'2025-03-01 10:00:00' hour, 'PushEvent' event_type, 5L event_count, 2L unique_users,"
        " 3L unique_repos, date'2025-03-01' event_date"
    )
    tables.overwrite_table(rows, name)
    tables.overwrite_table(rows.select(*reversed(rows.columns)), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [tuple(rows.first())]
    tables.append_table(rows, name)
    assert spark.table(name).count() == 2
    assert tables.table_exists(spark, name) and not tables.table_exists(spark, f"{database}.nothing")
    tables.ensure_database(spark, database)
    assert tables.table_or_empty(spark, name).count() == 2
    assert tables.table_or_empty(spark, "nowhere.mart_hourly_activity").columns == rows.columns
    with pytest.raises(ValueError):
        tables.write_jdbc(rows, "jdbc:none", "t", mode="ignore")


def test_partition_overwrite_leaves_other_days(spark, database):
    name = f"{database}.mart_repo_activity"

    def day(d, n):
        return spark.sql(
            f"select timestamp'{d} 10:00:00' hour, 1L repo_id, 'a/b' repo_name, {n}L total_events,"
            f" 1L unique_actors, 0L stars_gained, 0L forks_gained, 0L total_commits, date'{d}' event_date"
        )

    tables.overwrite_table(day("2025-03-01", 1).union(day("2025-03-02", 2)), name)
    tables.overwrite_partitions(day("2025-03-02", 9), name)
    found = {str(r.event_date): r.total_events for r in spark.table(name).collect()}
    assert found == {"2025-03-01": 1, "2025-03-02": 9}
