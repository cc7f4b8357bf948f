"""Stored tables: declaration, presence check, idempotent overwrite, append, JDBC copy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.schemas import OPTIONAL_TABLES, TABLES, TableContract


def ensure_table(spark: SparkSession, name: str, contract: TableContract) -> None:
    layout = f" PARTITIONED BY ({', '.join(contract.partition_by)})" if contract.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({contract.ddl}) USING parquet{layout}")


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, contract in TABLES.items():
        ensure_table(spark, f"{database}.{name}", contract)


def ensure_optional(spark: SparkSession, database: str, table: str) -> str:
    """Declare one of the optional tables; returns its full name."""
    ensure_table(spark, f"{database}.{table}", OPTIONAL_TABLES[table])
    return f"{database}.{table}"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_or_empty(spark: SparkSession, name: str) -> DataFrame:
    """The table, or no rows of its contract where it has not been built yet."""
    if table_exists(spark, name):
        return spark.table(name)
    return spark.createDataFrame([], TABLES[name.split(".")[-1]].schema)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace all rows and keep the table's definition: a rerun leaves the same rows."""
    _insert_overwrite(_conform(df, name), name, "static")


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    _insert_overwrite(_conform(df, name), name, "dynamic")


def _insert_overwrite(df: DataFrame, name: str, mode: str) -> None:
    """``insertInto`` takes the partition overwrite mode from the session only."""
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, mode)
    try:
        df.write.mode("overwrite").insertInto(name)
    finally:
        conf.set(key, before)


def overwrite_listed(df: DataFrame, name: str, column: str, values: list[dt.date]) -> None:
    """Replace the partitions of the listed dates with rows that were stored before; a date without rows is dropped."""
    overwrite_partitions(df, name)
    left = {r[0] for r in df.select(column).distinct().collect()}
    for value in values:
        if value not in left:
            df.sparkSession.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = DATE'{value}')")


def append_table(df: DataFrame, name: str) -> None:
    _conform(df, name).write.mode("append").insertInto(name)


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Columns in table order and type; rows rebalanced over the partitions they land in.

    The rebalance keeps a day from being scattered into one small file per task, and lets
    adaptive execution split a day that holds most of the rows.
    """
    contract = (TABLES | OPTIONAL_TABLES).get(name.split(".")[-1])
    target = df.sparkSession.table(name).schema
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    if contract and contract.partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in contract.partition_by])
        inside = [c for c in contract.key if c not in contract.partition_by]
        if inside:
            out = out.sortWithinPartitions(*contract.partition_by, *inside)
    return out


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_size: int = 50_000,
    **options: str,
) -> None:
    """Copy to an external store in batches; ``overwrite`` empties the table and keeps it."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode is overwrite or append, not {mode!r}")
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", str(batch_size)).option("truncate", "true")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.mode(mode).save()
