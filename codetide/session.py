"""Spark session and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "codetide", **conf: str) -> SparkSession:
    """A session with the two settings the results depend on or always want: UTC and AQE.

    Memory, parallelism and connector jars belong to the cluster or to ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Days, hours and partitions are those of UTC; another session zone would shift them silently."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"set spark.sql.session.timeZone to UTC, not {zone}")


def is_cluster(spark: SparkSession) -> bool:
    """Whether executors are other processes than the driver."""
    master = spark.sparkContext.master
    return not master.startswith("local") or master.startswith("local-cluster")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    Only a local-mode session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if is_cluster(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="codetide-")


#: Folder of the run that is under way, if any.
_run: ContextVar[str | None] = ContextVar("run", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, in the folder of the run that is under way."""
    own = uuid.uuid4().hex
    return f"{_run.get() or f'{shared_dir(spark)}/codetide'}/{own}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that survive the loss of any executor.
    """
    return _stored(df, scratch_path(df.sparkSession, name))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Library code that cuts its own lineage needs a checkpoint folder: the session's, or a lasting one in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/codetide/checkpoints")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """One folder for all intermediate tables written inside, removed at the end, also after a failure.

    What is to outlive it goes through the function that is yielded, which stores it outside.
    """
    outer = scratch_path(spark, "kept")
    folder = scratch_path(spark, "run")
    token = _run.set(folder)
    try:
        yield lambda df, name: _stored(df, f"{outer}/{name}")
    finally:
        _run.reset(token)
        remove_folder(spark, folder)
