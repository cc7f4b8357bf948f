"""Hour archives: gzip JSON-lines files named ``YYYY-MM-DD-H.json.gz`` (hour not padded)."""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.schemas import RAW_EVENT
from codetide.session import materialise, scratch
from codetide.sources.tables import append_table, overwrite_partitions

# Pattern and layout of an archive name.
ARCHIVE_NAME = r"^(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json\.gz$"
ARCHIVE_GLOB = "*.json.gz"

# Unicode white space, stripped from both ends of a line.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def read_archives(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw events with the declared schema; a broken line reads as a row of nulls."""
    return spark.read.schema(RAW_EVENT).json(list(paths))


def archive_name(hour: Column) -> Column:
    """File name of the archive that holds the events of ``hour``."""
    return F.concat(
        F.date_format(hour, "yyyy-MM-dd"), F.lit("-"), F.hour(hour).cast("string"),
        F.lit(".json.gz"),
    )


def source_key(file_name: Column) -> Column:
    """The name a landed file is recorded under: without the ``.gz``."""
    return F.regexp_replace(file_name, r"\.gz$", "")


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Text lines of the archives with the name of the file each came from."""
    return spark.read.text(list(paths)).select("value", F.col("_metadata.file_name").alias("file_name"))


def land_lines(lines: DataFrame) -> DataFrame:
    """Lines of well-named archives, stripped, without blanks, keyed by day, hour and file.

    Expects the columns ``value`` and ``file_name``. Whole lines are kept as they are.
    """
    name, value = F.col("file_name"), F.col("value")
    bare = lambda text: F.btrim(text, F.lit(WHITE_SPACE))
    # Most lines begin with a letter and need not be stripped to tell that they are not blank. Names are cut by place once they match.
    return lines.where(name.rlike(ARCHIVE_NAME) & ((bare(F.left(value, F.lit(1))) != "") | (bare(value) != ""))).select(
        F.to_date(F.left(name, F.lit(10))).alias("event_date"),
        F.substring_index(F.substring(name, 12, 3), ".", 1).cast("int").alias("event_hour"),
        F.when(name.endswith(".gz"), F.left(name, F.length(name) - 3)).otherwise(source_key(name)).alias("source_file"),
        bare(value).alias("raw"),
    )


def list_archives(spark: SparkSession, directory: str) -> DataFrame:
    """Path and name of every well-named archive; the file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", ARCHIVE_GLOB)
        .load(directory)
        .select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"))
        .where(F.col("file_name").rlike(ARCHIVE_NAME))
    )


def not_landed(files: DataFrame, landed: DataFrame) -> DataFrame:
    """Files, given by ``file_name``, that left no row in the landed table."""
    known = landed.select("source_file").distinct()
    return files.withColumn("source_file", source_key(F.col("file_name"))).join(
        known, "source_file", "left_anti"
    )


def landed_counts(landed: DataFrame) -> DataFrame:
    """Landed lines per file."""
    return landed.groupBy("source_file").agg(F.count(F.lit(1)).alias("lines"))


#: Characters of lines that are handed on at a time; bytes of archives that a task is handed at a time, one archive at least.
LINES_AT_ONCE, ARCHIVES_AT_ONCE = 4 << 20, 32 << 20


def archive_fault(content: bytes) -> str | None:
    """Why an archive cannot be read to its end, or None. It is unpacked piece by piece and its checksum compared.

    A file without a byte never gets here: the file source gives no row for it, and its hour stays missing.
    """
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as unpacked:
            while unpacked.read(1 << 20):
                pass
    except EOFError:
        return "truncated"
    except (gzip.BadGzipFile, zlib.error):
        return "corrupt"
    return None


_WHOLE = pa.schema([("file_name", pa.string()), ("path", pa.string()), ("value", pa.string()), ("reason", pa.string())])


def whole_archives(files: DataFrame) -> DataFrame:
    """file_name, path, value, reason: the lines of archives (``path``, ``content``) that are intact; of others one row with the reason.

    The file source gives the lines before a fault and then fails or goes on, so archives are unpacked here, an archive at a time.
    """
    files.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARCHIVES_AT_ONCE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                path, content = path.as_py(), content.as_py()
                name, reason = path.rsplit("/", 1)[-1], archive_fault(content)
                if reason:
                    yield pa.RecordBatch.from_pylist([{"file_name": name, "path": path, "reason": reason}], schema=_WHOLE)
                    continue
                with gzip.open(io.BytesIO(content), "rt", encoding="utf-8", errors="replace") as unpacked:
                    while lines := unpacked.readlines(LINES_AT_ONCE):
                        rows = [[name] * len(lines), [path] * len(lines), [x.rstrip("\n") for x in lines], [None] * len(lines)]
                        yield pa.RecordBatch.from_arrays([pa.array(r, pa.string()) for r in rows], schema=_WHOLE)

    return files.select("path", "content").mapInArrow(run, "file_name string, path string, value string, reason string")


def set_aside(found: DataFrame, database: str) -> None:
    """Record the archives that could not be read; one that is known already is not recorded again."""
    table = f"{database}.archives_quarantined"
    faulty = found.where(F.col("reason").isNotNull() & F.col("file_name").rlike(ARCHIVE_NAME))
    known = found.sparkSession.table(table).select("path")
    new = faulty.select(source_key(F.col("file_name")).alias("source_file"), "path", "reason").distinct().join(known, "path", "left_anti")
    append_table(materialise(new, "faulty"), table)


def land_batch(files: DataFrame, database: str) -> None:
    """Land the lines of intact archives and set the others aside. Each file is its own partition and overwritten as a whole."""
    with scratch(files.sparkSession):
        found = materialise(whole_archives(files), "found")
        set_aside(found, database)
        overwrite_partitions(land_lines(found.where("reason is null")), f"{database}.events_raw")
