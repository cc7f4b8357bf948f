"""Loading archives as they arrive: land them, then rebuild the days that they touch.

An archive may arrive at any time, also days after its neighbours, and a load that died half way is repaired by the next one. What a
load reads and writes follows what has arrived: the landed lines themselves, the ranges of the id index that their ids
fall into, and the days of their events and of the copies that the index finds. Days are few, so they pass through the
driver and prune the partitions of every table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.operators.cleaning import clean_events, dedup_events
from codetide.operators.snapshots import Windows
from codetide.plans.aggregates import update_panes, update_uniques
from codetide.plans.etl import MARTS, dated
from codetide.schemas import OPTIONAL_TABLES, RAW_EVENT, TABLES
from codetide.session import materialise, require_utc, scratch
from codetide.sources.archives import land_lines, set_aside, whole_archives
from codetide.sources.tables import append_table, ensure_database, overwrite_listed, overwrite_partitions, overwrite_table, table_exists
from codetide.streaming.archives import each_arrival

#: Ids of one range of the index, where ids are numbers; ranges of the other ids, by hash.
RANGE_IDS, HASH_RANGES = 1 << 22, 256
#: Ranges that are named in a filter at most; beyond, the join alone finds them.
MOST_RANGES = 10_000


def parsed(landed: DataFrame) -> DataFrame:
    """Raw events of landed lines; a broken line gives a row of nulls, which the cleaning drops.

    The event is generated, not projected: the filters of the cleaning would otherwise be moved below the parser and
    parse the line again for each field that they look at.
    """
    return landed.select(F.inline(F.array(F.from_json("raw", RAW_EVENT))))


def id_range(event_id: str = "event_id") -> Column:
    """Range of the index that an id belongs to.

    Ids that are numbers grow with time, so the ids of a load fall into few ranges; others are spread by hash.
    """
    number = F.col(event_id).try_cast("bigint")
    hashed = F.concat(F.lit("h"), F.pmod(F.xxhash64(event_id), F.lit(HASH_RANGES)).cast("string"))
    return F.coalesce(F.floor(number / F.lit(RANGE_IDS)).cast("string"), hashed)


def _days_of(events: DataFrame) -> DataFrame:
    return events.select("event_id", "event_date", id_range().alias("id_range"))


def build_index(spark: SparkSession, database: str) -> None:
    """The index of all stored events, from two of their columns."""
    overwrite_table(_days_of(spark.table(f"{database}.events_parsed")), f"{database}.event_days")


def indexed_days(spark: SparkSession, database: str, ids: DataFrame) -> DataFrame:
    """event_id, event_date of the given ids (stored): a superset of the days in which they are stored."""
    index = spark.table(f"{database}.event_days")
    wanted = ids.select("event_id", id_range().alias("id_range"))
    ranges = [r.id_range for r in wanted.select("id_range").distinct().limit(MOST_RANGES + 1).collect()]
    if len(ranges) <= MOST_RANGES:
        index = index.where(F.col("id_range").isin(ranges))
    return index.join(wanted, ["id_range", "event_id"], "left_semi").select("event_id", "event_date").distinct()


def merge_arrivals(
    lines: DataFrame, database: str, as_of: dt.datetime | None = None, panes: Windows | None = None, uniques: bool = False
) -> None:
    """Land lines (``value``, ``file_name``) of whole archives and bring events and marts up to date.

    An id may have a copy in an archive loaded before, on the same day or another; the earliest valid one is kept, so the days that
    are rebuilt are those of the new events and of the copies that they replace. All others are neither read nor written.
    Running the same arrivals again changes nothing. On request the feature panes of ``panes`` and the hourly sketches are kept, too.
    """
    spark = lines.sparkSession
    require_utc(spark)
    with scratch(spark):
        _merge(spark, materialise(land_lines(lines), "landed"), database, as_of, panes, uniques)


def _merge(
    spark: SparkSession, landed: DataFrame, database: str, as_of: dt.datetime | None, panes: Windows | None, uniques: bool
) -> None:
    overwrite_partitions(landed, f"{database}.events_raw")
    fresh = materialise(dated(clean_events(parsed(landed), as_of), "created_at"), "fresh")
    if fresh.isEmpty():
        return
    if spark.sql(f"SHOW PARTITIONS {database}.event_days").isEmpty():  # a new database, or one that was loaded as a whole
        build_index(spark, database)

    ids = fresh.select("event_id")
    known = materialise(indexed_days(spark, database, ids), "known")
    touched = fresh.select("event_date").union(known.select("event_date")).distinct()
    days = sorted(r.event_date for r in touched.collect())  # at most as many as the calendar has
    stored = spark.table(f"{database}.events_parsed").where(F.col("event_date").isin(days)).select(*fresh.columns)
    if stored.isEmpty():  # the new events, which have been deduplicated, are all that these days have
        kept = rebuilt = fresh
    else:
        copies = stored.join(ids, "event_id", "left_semi")
        others = stored.join(ids, "event_id", "left_anti")
        events = [c for c in fresh.columns if c != "event_date"]
        kept = dated(dedup_events(fresh.unionByName(copies).select(*events)), "created_at")
        kept = materialise(kept.select(*fresh.columns), "kept")
        rebuilt = materialise(others.unionByName(kept), "days")

    # The index first: a day too many in it costs reading that day, a day too few would lose a copy.
    new = kept.select("event_id", "event_date").join(known, ["event_id", "event_date"], "left_anti")
    append_table(_days_of(new), f"{database}.event_days")
    overwrite_listed(rebuilt, f"{database}.events_parsed", "event_date", days)
    for name, build in MARTS.items():
        mart = materialise(dated(build(rebuilt), "hour"), name)
        overwrite_listed(mart, f"{database}.{name}", "event_date", days)
    if uniques:
        update_uniques(spark, database, days)
    if panes:
        update_panes(spark, database, panes, days)


def load_arrivals(
    spark: SparkSession, directory: str, database: str, checkpoint: str, as_of: dt.datetime | None = None,
    panes: Windows | None = None, uniques: bool = False,
) -> None:
    """One incremental run over a directory of archives: all that have appeared since the last run.

    Archives that cannot be read to their end are set aside with the reason; nothing of them is landed.
    """
    require_utc(spark)
    ensure_database(spark, database)

    def load(files: DataFrame) -> None:
        with scratch(files.sparkSession):
            found = materialise(whole_archives(files), "found")
            set_aside(found, database)
            merge_arrivals(found.where("reason is null"), database, as_of, panes, uniques)

    each_arrival(spark, directory, checkpoint, load)
    for name in [*TABLES, *OPTIONAL_TABLES]:  # the stream's batches ran in a session of their own
        if table_exists(spark, f"{database}.{name}"):
            spark.catalog.refreshTable(f"{database}.{name}")
