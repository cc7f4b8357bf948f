"""Minimax contiguous shards of ordered atomic groups.

Groups, here the documents of equal text, stand in the order of their keys and are never split. The smallest shard
capacity for which a greedy walk needs no more than the wanted shards is found by binary search, and the walk with
that capacity gives the cuts.

The walk needs one thing of the data: the largest group end that is not beyond a position. Ends are cumulative sizes,
computed per slice of the key space and stored. The driver holds a summary of them (least, greatest and number of ends per
interval); where the walk hits the inside of an interval, only that interval is summarised more finely and the
search goes on. What is collected is bounded by the shards and the search depth, not by the number of groups.

A group as large as the capacity fills its shard alone and says nothing about the others, so the groups before and after it are cut by the same search over
the shards that are left. Where no group sets the capacity, each shard in turn takes as little above the mean of what is left as the rest can
bear. The largest shard is as small as it can be in every part, and shards are not left empty by a greedy walk.

Defined cases: a null text has no bytes and counts as an empty one; repeated rows are documents of their own; fewer groups than
shards leave shards empty; no rows give no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codetide.llm.common import materialise, text_key, whole_text

T = TypeVar("T")

SHARDS = 8
#: Groups of one slice of the key space, whose running sums one task computes.
SLICE = 50_000
#: Intervals into which the summary divides what it has to see more finely.
INTERVALS = 1024
#: Documents of one shard that one task numbers.
CELL = 50_000


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, group key, size and checksum of every document; texts are read here only."""
    text = whole_text()
    return docs.select(
        "doc_id",
        text_key().alias("key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def group_ends(groups: DataFrame) -> DataFrame:
    """key, size -> key, size, end: sum of the sizes up to and with the group, in key order.

    Keys are hexadecimal digests, so equal slices of the key space hold about as many groups.
    """
    slices = max(1, math.ceil(groups.count() / SLICE))
    position = F.conv(F.substring("key", 1, 6), 16, 10).cast("long")
    sliced = groups.withColumn("slice", F.floor(position * slices / (1 << 24)))
    per_slice = sliced.groupBy("slice").agg(F.sum("size").alias("slice_size"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("slice", F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("slice").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sliced.withColumn("inside", F.sum("size").over(inside))
    return running.join(starts, "slice").select("key", "size", (F.col("start") + F.col("inside")).alias("end"))


class EndSummary:
    """Largest group end not beyond a position, from intervals (least end, greatest end, number of ends)."""

    def __init__(self, ends: DataFrame):
        self._ends = ends
        self.intervals: list[tuple[int, int, int]] = []
        low, high, n = ends.agg(F.min("end"), F.max("end"), F.count("end")).first()
        if n:
            self.intervals = [(low, high, n)]
        self._wanted: set[int] = set()

    def floor(self, position: int) -> int:
        """Exact, or the least it can be, noting the interval that has to be divided."""
        at = bisect_right(self.intervals, (position, math.inf, math.inf)) - 1
        if at < 0:
            return 0
        low, high, n = self.intervals[at]
        if position >= high:
            return high
        if n > 2:
            self._wanted.add(at)
        return low

    def above(self, position: int) -> int:
        """Least end beyond a position, likewise."""
        at = bisect_right(self.intervals, (position, math.inf, math.inf)) - 1
        if at < 0:
            return self.intervals[0][0]
        low, high, n = self.intervals[at]
        if position >= high:
            return self.intervals[at + 1][0] if at + 1 < len(self.intervals) else high
        if n > 2:
            self._wanted.add(at)
        return high

    def unsure(self) -> bool:
        """Whether an answer given since the last division may be off."""
        return bool(self._wanted)

    def settled(self, ask: Callable[[], T]) -> T:
        """The answer once no interval that it depends on has to be divided."""
        answer = ask()
        while self.unsure():
            self.divide()
            answer = ask()
        return answer

    def divide(self) -> None:
        """Summarise the noted intervals more finely, all in one job."""
        noted = [self.intervals[i] for i in sorted(self._wanted)]
        self._wanted.clear()
        share = max(2, INTERVALS // len(noted))
        keep = [x for x in self.intervals if x not in noted]
        end, cell = F.col("end"), None
        for k, (low, high, _) in enumerate(noted):
            width = max(1, -(-(high - low + 1) // share))
            inside = end.between(low, high)
            number = F.lit(k * (share + 1)) + F.floor((end - low) / F.lit(width))
            cell = F.when(inside, number) if cell is None else cell.when(inside, number)
        found = (
            self._ends.select("end", cell.alias("cell")).where(F.col("cell").isNotNull())
            .groupBy("cell").agg(F.min("end"), F.max("end"), F.count("end")).collect()
        )
        self.intervals = sorted(keep + [tuple(row[1:]) for row in found])


def greedy_cuts(summary: EndSummary, capacity: int, shards: int, start: int, stop: int) -> list[int] | None:
    """Ends of the last groups of shards from ``start`` to ``stop``, or None where the groups need more shards."""
    cuts, at = [], start
    for _ in range(shards):
        at = summary.floor(min(at + capacity, stop)) if at < stop else stop
        cuts.append(at)
    return cuts if at >= stop else None


def least_capacity(summary: EndSummary, largest: int, shards: int, start: int, stop: int) -> int:
    """Smallest feasible capacity, by binary search."""
    mean = -(-(stop - start) // shards)
    low, high = max(largest, mean), mean + largest  # the upper one is always feasible
    while low < high:
        middle = (low + high) // 2
        fits = summary.settled(lambda: greedy_cuts(summary, middle, shards, start, stop)) is not None
        low, high = (low, middle) if fits else (middle + 1, high)
    return low


def even_cuts(summary: EndSummary, capacity: int, shards: int, start: int, stop: int) -> list[int]:
    """Cuts within the capacity, each shard as little above the mean of what is left as the rest can bear."""
    cuts, at = [], start
    for left in range(shards, 0, -1):
        if at < stop:
            first = summary.settled(lambda: summary.above(at))
            low, high = max(-(-(stop - at) // left), first - at), capacity
            while low < high:
                middle = (low + high) // 2
                fits = summary.settled(lambda: greedy_cuts(summary, capacity, left - 1, summary.floor(min(at + middle, stop)), stop))
                low, high = (low, middle) if fits is not None else (middle + 1, high)
            at = summary.settled(lambda: summary.floor(min(at + low, stop)))
        cuts.append(at)
    return cuts


def minimax_cuts(ends: DataFrame, shards: int, start: int, stop: int, summary: EndSummary | None = None) -> list[int]:
    """Cuts of the groups between two ends over the stored ends; where a group sets the capacity, of both sides of it."""
    if start >= stop or shards < 1:
        return [stop] * shards
    summary = summary or EndSummary(ends)
    inside = ends.where((F.col("end") > start) & (F.col("end") <= stop))
    size, end = inside.agg(F.max(F.struct("size", "end")).alias("x")).select("x.*").first()
    capacity = least_capacity(summary, size, shards, start, stop)
    if capacity > size or (stop - start) >= size * shards:
        return even_cuts(summary, capacity, shards, start, stop)
    before, after = end - size - start, stop - end

    def needed(low: int, high: int) -> int:
        return next(k for k in range(shards + 1) if low >= high or k and summary.settled(lambda: greedy_cuts(summary, capacity, k, low, high)) is not None)

    share = round((shards - 1) * before / max(1, before + after))
    first = min(max(share, needed(start, end - size)), shards - 1 - needed(end, stop))
    return [
        *minimax_cuts(ends, first, start, end - size, summary), end,
        *minimax_cuts(ends, shards - 1 - first, end, stop, summary),
    ]


def _shard_of(last_keys: list[str]) -> Column:
    """Number of the shard by the keys of the shards' last groups, ascending."""
    shard = F.lit(0)
    for key in last_keys:
        shard = shard + (F.col("key") > F.lit(key)).cast("int")
    return shard


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, key, shard, slot. Copies of a text share a shard; slots have no gap."""
    sized = materialise(sized_documents(docs), "sized")
    groups = sized.groupBy("key").agg(F.sum("size").alias("size"))
    ends = materialise(group_ends(groups), "ends")
    total = ends.agg(F.max("end")).first()[0]
    last_keys: list[str] = []
    if total:
        cuts = sorted({c for c in minimax_cuts(ends, shards, 0, total) if 0 < c < total})
        last_keys = sorted(r.key for r in ends.where(F.col("end").isin(cuts)).select("key").collect())
    cells = max(1, math.ceil(sized.count() / CELL))
    placed = sized.withColumn("shard", _shard_of(last_keys)).withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells))
    )
    per_cell = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_cell.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "key")
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(firsts, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "key", "shard", (F.col("first") + F.col("place")).alias("slot")
    )


def shard_query(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The digest of ``shard_documents`` under the law of near equal bytes."""
    return shard_documents(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
