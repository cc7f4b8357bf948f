"""Reads the ``events`` click-stream table as raw code-hosting events.

One user is an organisation with ten repositories; a third of the events belong to five of them. The mapping also brings in what
the cleaning has to cope with: copies that differ, some of them invalid, missing ids and names, malformed and impossible times, huge
pushes, repositories that change their name within an hour and over time, instants that events share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.schemas import FORK, PULL_REQUEST, PUSH, STAR
from codetide.session import require_utc
from codetide.sources.archives import archive_name

# Event types, languages and malformed texts of the mapping.
TYPE_OF = {"click": PUSH, "view": STAR, "purchase": PULL_REQUEST, "signup": FORK, "error": "IssuesEvent"}
LANGUAGES = (
    "Python Go Rust Java C++ C Kotlin Swift Ruby PHP Scala Haskell Elixir Erlang Clojure Lua Perl R Julia Dart "
    "TypeScript JavaScript Shell Zig Nim OCaml Fortran Ada Cobol Prolog Scheme Racket Groovy Crystal Solidity Vala"
).split()
NO_TIME = "yesterday"
STRAY_ARCHIVE = "unsorted.json.gz"


def read_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    require_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _chosen(key: Column, values: dict) -> Column:
    first, *others = values.items()
    choice = F.when(key == first[0], first[1])
    for match, value in others:
        choice = choice.when(key == match, value)
    return choice


def _record(keyed: Column, second: Column) -> Column:
    """The raw event, or its second copy: up to an hour earlier or later, with one commit more, sometimes without repository."""
    event_id, k, kind, owner = (keyed[c] for c in ("event_id", "k", "kind", "owner"))
    turn = F.floor(event_id / 50)
    hours = F.when(second, (turn % 3 - 1).cast("int")).otherwise(0)
    at = keyed["at"] + F.make_dt_interval(hours=hours)
    size = F.when(second, F.coalesce(keyed["size"], F.lit(0)) + 1).otherwise(keyed["size"])
    repo_id = F.when((event_id % 89 != 0) & (~second | (turn % 5 != 0)), owner * 10 + k % 10)
    text = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    actor = F.when(event_id % 71 != 0, keyed["user_id"] * 3 + F.floor(k / 10).cast("int") % 3)
    language = F.get(F.array(*[F.lit(x) for x in LANGUAGES]), ((k + owner) % (len(LANGUAGES) + 1)).cast("int"))
    later_name = F.when((k % 10).isin(2, 3, 4) & (F.dayofmonth(keyed["at"]) >= 16), "-new").otherwise("")
    other_name = F.when((k % 10 == 7) & (event_id % 2 == 0), ".x").otherwise("")
    name = F.concat(F.lit("org"), owner.cast("string"), F.lit("/r"), (k % 10).cast("string"), later_name, other_name)
    return F.struct(
        event_id.cast("string").alias("id"),
        kind.alias("type"),
        F.struct(actor.alias("id"), F.concat(F.lit("dev"), actor.cast("string")).alias("login")).alias("actor"),
        F.struct(repo_id.alias("id"), F.when(event_id % 83 == 0, "").otherwise(name).alias("name")).alias("repo"),
        F.struct(
            _chosen(kind, {PULL_REQUEST: "opened", STAR: "started"}).alias("action"),
            size.alias("size"),
            F.struct(F.when(kind == FORK, language).alias("language")).alias("forkee"),
            F.struct(
                F.struct(F.struct(F.when(kind == PULL_REQUEST, language).alias("language")).alias("repo")).alias("base")
            ).alias("pull_request"),
        ).alias("payload"),
        F.when(event_id % 103 == 0, NO_TIME).otherwise(text).alias("created_at"),
    )


def raw_events(clicks: DataFrame) -> DataFrame:
    """Rows of the raw schema; every fiftieth event comes twice."""
    event_id, k = F.col("event_id"), F.translate("props", '{"k": }', "").cast("int")
    at = F.col("ts").cast("timestamp")
    at = F.when(event_id % 9 == 0, F.date_trunc("day", at)).otherwise(at)
    shifted = (
        F.when(event_id % 97 == 0, at - F.expr("interval 10 years"))
        .when(event_id % 101 == 0, at + F.expr("interval 50 years"))
        .otherwise(at)
    )
    keyed = clicks.select(
        F.struct(
            "event_id",
            "user_id",
            k.alias("k"),
            _chosen(F.col("event_type"), TYPE_OF).alias("kind"),
            F.when(event_id % 3 == 0, F.col("user_id") % 5).otherwise(F.col("user_id")).alias("owner"),
            F.when(k % 7 != 0, F.floor(F.col("value") * 60).cast("int")).alias("size"),
            shifted.alias("at"),
        ).alias("keyed")
    )
    # One record in the plan for both copies: with two, the generated method is too long for the JVM to compile, and is interpreted row by row.
    copies = F.when(F.col("keyed.event_id") % 50 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    copied = keyed.select("keyed", F.explode(copies).alias("second"))
    return copied.select(F.inline(F.array(_record(F.col("keyed"), F.col("second")))))


def raw_lines(clicks: DataFrame) -> DataFrame:
    """The raw events as JSON lines with the hour archive each belongs to."""
    raw = raw_events(clicks)
    hour = F.try_to_timestamp("created_at")
    return raw.select(
        F.to_json(F.struct(*raw.columns)).alias("value"),
        F.coalesce(archive_name(hour), F.lit(STRAY_ARCHIVE)).alias("file_name"),
        F.col("id").cast("long").alias("event_id"),
    )


def untidy_lines(clicks: DataFrame) -> DataFrame:
    """The same lines with blanks around some of them, and with blank and broken lines in between."""
    value, event_id = F.col("value"), F.col("event_id")
    padded = F.when(event_id % 61 == 0, F.concat(F.lit("\t "), value, F.lit("  "))).otherwise(value)
    blank, broken = F.when(event_id % 59 == 0, "   "), F.when(event_id % 67 == 0, '{"id": "')
    lines = F.filter(F.array(padded, blank, broken), lambda x: x.isNotNull())
    return raw_lines(clicks).select(F.explode(lines).alias("value"), "file_name")


def store_archives(lines: DataFrame, path: str) -> str:
    """Write lines as one gzip file per archive name; returns the folder. For tests and queries: one rename per archive."""
    spark = lines.sparkSession
    parts = lines.select("value", "file_name").repartition("file_name")
    parts.write.partitionBy("file_name").option("compression", "gzip").text(f"{path}/parts")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/archives")
    store = folder.getFileSystem(conf)
    store.mkdirs(folder)
    for part in store.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/parts/file_name=*/part-*")):
        name = part.getPath().getParent().getName().removeprefix("file_name=")
        store.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(folder, name))
    return folder.toString()


def cut_archive(spark: SparkSession, folder: str, name: str) -> None:
    """Replace an archive by its first half, as a broken transfer leaves it. For tests and queries."""
    content = spark.read.format("binaryFile").load(f"{folder}/{name}").select("content").first()[0]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(conf).create(path, True)
    out.write(bytearray(content[: len(content) // 2]))
    out.close()


def landed_all(clicks: DataFrame) -> DataFrame:
    """Landed table of a load that has taken the whole stream."""
    hour = F.col("ts").cast("timestamp")
    return clicks.select(
        F.to_date("ts").alias("event_date"),
        F.hour("ts").alias("event_hour"),
        F.regexp_replace(archive_name(hour), r"\.gz$", "").alias("source_file"),
    )


def landed_before_last_day(clicks: DataFrame) -> DataFrame:
    """Landed table of a load that has taken everything but the last day of the stream."""
    last_day = F.to_date(clicks.agg(F.max("ts")).scalar())
    return landed_all(clicks.where(F.to_date("ts") < last_day))
