"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.llm.common import materialise


def _to_least(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Links every neighbour of a node, or its smaller ones, to the least of them and the node.

    The least is combined before the shuffle; a node with very many neighbours is then a skewed join, which adaptive execution splits.
    """
    if smaller_only:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        around = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = around.join(least, "a")
    moved = joined.where(F.col("b") > F.col("a")) if not smaller_only else joined
    out = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if smaller_only:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root) of every linked node but the roots; the root is the least node."""
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        edges = materialise(_to_least(_to_least(edges, False), True), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
