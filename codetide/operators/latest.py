"""Last version of each key, the read semantics of a replacing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], *newest_first: Column) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps only the first row per key in every task before it shuffles (window group
    limit), so a key with many versions does not gather in one place.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` holds its overall maximum."""
    newest = df.agg(F.max(column).alias("newest")).scalar()
    return df.where(F.col(column) == newest)
