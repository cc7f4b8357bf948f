"""Runs queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    try:
        con.execute("SET TimeZone = 'UTC'")
        for path in sorted(Path(sf_dir).glob("*.parquet")):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
        cursor = con.execute(sql)
        return [d[0] for d in cursor.description], cursor.fetchall()
    finally:
        con.close()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") if math.isfinite(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (int, str, dt.date)):
        return value
    return str(value)


def canonical(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    names, rows = duckdb_rows(sql, sf_dir)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    ours = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = canonical(names, rows)
    if ours == theirs:
        return None if ours else "both sides are empty"
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())};"
        f" only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
    )
