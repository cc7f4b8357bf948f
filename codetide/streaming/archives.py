"""Archives that keep arriving, as a stream of their lines.

The checkpoint remembers the files already read. Nothing depends on event time, so an archive that comes late loses no line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codetide.sources.archives import ARCHIVE_GLOB, land_batch, land_lines


def arriving_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Text lines of the archives that appear in a directory, with the name of their file."""
    lines = spark.readStream.option("pathGlobFilter", ARCHIVE_GLOB).text(directory)
    return lines.select("value", F.col("_metadata.file_name").alias("file_name"))


#: Archives of one micro-batch.
MOST_FILES = 1000
# The columns of the source of whole files.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_archives(spark: SparkSession, directory: str) -> DataFrame:
    """The archives that appear in a directory, packed as they are."""
    files = spark.readStream.schema(BINARY_FILE).format("binaryFile").option("pathGlobFilter", ARCHIVE_GLOB).option("maxFilesPerTrigger", MOST_FILES)
    return files.load(directory).select("path", "content")


def each_arrival(spark: SparkSession, directory: str, checkpoint: str, load: Callable[[DataFrame], None]) -> None:
    """Give ``load`` all archives that have appeared since the last run, some at a time.

    The stream's checkpoint lists the files already read, so no list of paths passes through the driver's code, and a batch that failed is
    given again.
    """
    query = (
        arriving_archives(spark, directory).writeStream
        .foreachBatch(lambda batch, _: load(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_new_archives(spark: SparkSession, directory: str, database: str, checkpoint: str) -> None:
    """Land the archives that have appeared since the last run; a run that died half way is repaired by the next one."""
    each_arrival(spark, directory, checkpoint, lambda batch: land_batch(batch, database))
    for name in ("events_raw", "archives_quarantined"):
        spark.catalog.refreshTable(f"{database}.{name}")


def stream_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Landed lines of the archives that appear in a directory."""
    return land_lines(arriving_lines(spark, directory))


def append_available(df: DataFrame, path: str, checkpoint: str, *partition_by: str) -> StreamingQuery:
    """Append everything that has arrived since the last run as parquet, then stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*partition_by)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
