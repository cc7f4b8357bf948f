"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from codetide.session import materialise

#: Bytes that an executor hands its Python worker at once: what both hold of a text table at a time.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

__all__ = [
    "BATCH_BYTES", "DOCUMENT_COLUMNS", "Remembered", "documents", "in_batches", "item_blocks", "join_listed", "keep_rows", "map_text", "materialise", "read_table",
    "text_key", "whole_text",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def whole_text(column: str = "text") -> Column:
    """The text; a null text reads as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """Strong digest that stands for a text wherever equal texts count as one."""
    return F.sha2(whole_text(column), 256)


class Remembered(dict):
    """Results of a function by key, for a worker that meets the same words again and again.

    Two generations: after ``size`` new keys those of the generation before are forgotten, unless they were asked for since. So
    frequent words stay, and memory is bounded.
    """

    def __init__(self, function: Callable, size: int):
        super().__init__()
        self._function, self._size, self._before = function, size, {}

    def __missing__(self, key):
        if len(self) >= self._size:
            self._before = dict(self)
            self.clear()
        found = self[key] = self._before[key] if key in self._before else self._function(key)
        return found


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_BYTES`` (or one row), whatever the length of the texts.

    The limit is a setting of the session, read when the plan runs; it is lowered here and never raised.
    """
    conf = df.sparkSession.conf
    held = conf.get(_BATCH_SETTING).strip().lower().removesuffix("b")
    if not (held.isdigit() and 0 < int(held) <= BATCH_BYTES):
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def keep_rows(df: DataFrame, passes: Callable[[], Callable[[str], bool]]) -> DataFrame:
    """The rows, with all their columns, whose text passes; ``passes`` makes the test once per task. A null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = passes()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([test(t.as_py() or "") for t in texts], pa.bool_()))

    return in_batches(df, run, df.schema)


def item_blocks(items: DataFrame, size: int, *by: str) -> Iterator[list[tuple]]:
    """The rows of a stated query set in blocks of about ``size``, by the hash of ``by``; one block at a time is on the driver."""
    items = materialise(items, "items")
    blocks = max(1, -(-items.select(*by).distinct().count() // size))
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64(*by), F.lit(blocks)) == k).collect()
        if rows:
            yield [tuple(r) for r in rows]


#: Rows of narrow columns that are broadcast at most, after they have been counted.
MOST_LISTED = 100_000


def join_listed(df: DataFrame, listed: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join with a stored list that is expected to be short.

    The list is broadcast where its counted rows are few, so that a key with very many rows of ``df`` stays where it is; a longer list is joined
    by a shuffle, in which adaptive execution splits such a key.
    """
    few = listed.count() <= MOST_LISTED
    return df.join(F.broadcast(listed) if few else listed, on, how)


def map_text(
    df: DataFrame,
    function: Callable[[list[dict]], Iterator[dict] | list[dict]],
    schema: str | StructType,
    batch: int = 256,
) -> DataFrame:
    """Rows that ``function`` makes of up to ``batch`` rows at a time, Arrow in and out.

    Small batches keep long texts from piling up in a worker.
    """
    spark = df.sparkSession
    made = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for received in batches:
            for at in range(0, received.num_rows, batch):
                rows = list(function(received.slice(at, batch).to_pylist()))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return in_batches(df, run, made)
