"""A random forest that grows in tasks and is stored as rows, for sets whose nodes the driver cannot hold.

The library keeps all nodes of the trees it fits on the driver, and every task of a level holds statistics of all nodes of the level. Leaves are as
small for many rows as for few, so both grow with the rows. Here features are cut into bins once and every tree draws its rows. As long as a node has
more than ``ROWS_GROWN`` rows, the counts of its bins are added up over all parts of the rows, and the driver takes its best split; those are the few
nodes at the top. The rows of every other node are brought together, and a task grows what is below.

As in the library's forest, a row is drawn for a tree with a Poisson number of copies, a split is the best of as many features as the root of their
number, by the decrease of the weighted Gini impurity, and sibling leaves of the same class become one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, pairwise
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetide.operators.trees import BINS, Tops, best_splits, draws, grown, matrix, tried_features
from codetide.plans.model_tables import MOST_VOTES, StoredForest, save_parts, saved_parts, share_path
from codetide.session import materialise, scratch_path

#: Drawn rows of a node that one task grows on its own.
ROWS_GROWN = 200_000
#: Nodes of a share of the trees, about; trees whose rows are sent in one batch; drawn rows that a task grows in one go, about.
NODES_PER_SHARE, TREES_PER_BATCH, ROWS_PER_GROWTH = 450_000, 16, 2_000_000
BINNED = "row bigint, x binary, label tinyint"
SENT = "tree int, top int, rows binary"
COUNTED = "tree int, top int, counts binary"
SPLIT = "tree int, top int, place int, bin int, gain double, left_0 bigint, left_1 bigint, right_0 bigint, right_1 bigint"
GROWN = "tree int, top int, node int, place int, threshold double, left int, right int, gain double, n_0 bigint, n_1 bigint"


def bin_limits(values: DataFrame) -> list[list[float]]:
    """Of each place of the array ``x``, the values up to which a split may go left: between all values, or quantiles where there are more than bins."""
    pairs = values.select(F.posexplode("x").alias("place", "value"))
    distinct = pairs.distinct()
    count = {r.place: r.n for r in distinct.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    few: dict[int, list[float]] = {p: [] for p, n in count.items() if n <= BINS}
    for r in distinct.where(F.col("place").isin([*few])).collect():
        few[r.place].append(r.value)
    limits = {p: [(a + b) / 2 for a, b in pairwise(sorted(v))] for p, v in few.items()}
    quantiles = F.percentile_approx("value", [k / BINS for k in range(1, BINS)], 10_000)
    many = pairs.where(~F.col("place").isin([*few])).groupBy("place").agg(quantiles.alias("q"), F.max("value").alias("most"))
    limits |= {r.place: sorted({v for v in r.q if v < r.most}) for r in many.collect()}
    return [limits[p] for p in range(len(limits))]


def binned_rows(featured: DataFrame, limits: list[list[float]], label: str) -> DataFrame:
    """A number, the bins as bytes and the label of each row."""

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch.x.to_numpy()) if len(batch) else np.zeros((0, len(limits)))
            packed = np.stack([np.searchsorted(np.array(v), x[:, i], side="left") for i, v in enumerate(limits)], 1).astype(np.uint8)
            yield pd.DataFrame({"row": batch.row, "x": [row.tobytes() for row in packed], "label": batch.label})

    numbered = featured.select(F.monotonically_increasing_id().alias("row"), "x", F.col(label).cast("tinyint").alias("label"))
    return materialise(numbered.mapInPandas(bins, BINNED), "binned")


def grow_tops(rows: DataFrame, n: int, width: int, weights: np.ndarray, trees: int, depth: int, least: int, seed: int) -> Tops:
    """Splits nodes of more than ``ROWS_GROWN`` rows, one job a level, from the counts of their bins in all parts of the rows."""
    tops = Tops(trees)
    large = [(tree, 0) for tree in range(trees)] if n > ROWS_GROWN and depth else []
    tried = lambda tree, top: tried_features(np.random.default_rng([seed, tree, top, 1]), 1, width)[0]
    while large:

        def count(batches: Iterator[pd.DataFrame], large: list[tuple[int, int]] = large) -> Iterator[pd.DataFrame]:
            counts = {node: np.zeros((2, len(tried(*node)), BINS), np.int64) for node in large}
            for batch in batches:
                x, label = matrix(batch.x, width), batch.label.to_numpy().astype(np.int64)
                for tree in {tree for tree, _ in large}:
                    copies, at = draws(batch.row.to_numpy(), tree, seed), tops.reached(x, tree)
                    for top in (top for own, top in large if own == tree):
                        here = at == top
                        for i, feature in enumerate(tried(tree, top)):
                            key = label[here] * BINS + x[here, feature]
                            counts[tree, top][:, i] += np.bincount(key, copies[here], 2 * BINS).astype(np.int64).reshape(2, BINS)
            yield pd.DataFrame([(*node, c.tobytes()) for node, c in counts.items()], columns=["tree", "top", "counts"])

        def best(group: pd.DataFrame) -> pd.DataFrame:
            tree, top = int(group.tree.iloc[0]), int(group.top.iloc[0])
            counts = sum(np.frombuffer(c, np.int64) for c in group.counts).reshape(2, -1, BINS)
            left, total = counts.cumsum(2), counts.sum(2)
            at, gain = best_splits(left, total, weights, least)
            i = int(gain.argmax())
            a = left[:, i, at[i]]
            b = total[:, i] - a
            return pd.DataFrame([(tree, top, int(tried(tree, top)[i]), int(at[i]), float(gain[i]), *map(int, (*a, *b)))], columns=[c.split()[0] for c in SPLIT.split(", ")])

        found = rows.mapInPandas(count, COUNTED).groupBy("tree", "top").applyInPandas(best, SPLIT).collect()
        large = []
        for r in sorted(found):
            below = tops.split(r.tree, r.top, r.place, r.bin, r.gain, (r.left_0, r.left_1), (r.right_0, r.right_1), depth)
            large += [(r.tree, top) for top in below if tops.nodes[r.tree][top]["n_0"] + tops.nodes[r.tree][top]["n_1"] > ROWS_GROWN]
    return tops


def grow_bottoms(
    rows: DataFrame, n: int, limits: list[list[float]], weights: np.ndarray, own: list[int], tops: Tops, depth: int, least: int, seed: int, path: str
) -> DataFrame:
    """Nodes below every node at the bottom of the top that is no leaf, numbered from 0 each, stored by the shares ``own`` of the trees."""
    trees, ends = sum(own), [*accumulate(own)]
    thresholds = np.array([[*v, *[0.0] * (BINS - len(v))] for v in limits])

    width = len(limits)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, sent = matrix(batch.x, width), []
            for tree in range(trees):
                copies, at = draws(batch.row.to_numpy(), tree, seed), tops.reached(x, tree)
                whole = np.concatenate([x, batch.label.to_numpy(np.uint8)[:, None], copies[:, None]], 1)
                for top in (int(t) for t in np.unique(at[copies > 0]) if not tops.nodes[tree][t]["leaf"]):
                    sent.append((tree, top, whole[(copies > 0) & (at == top)].tobytes()))
                if (tree + 1) % TREES_PER_BATCH == 0 or tree + 1 == trees:
                    yield pd.DataFrame(sent, columns=["tree", "top", "rows"])
                    sent = []

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree, top = int(group.tree.iloc[0]), int(group.top.iloc[0])
        own = matrix(group.rows, width + 2)
        rng = np.random.default_rng([seed, tree, top, 2])
        nodes = grown(own[:, :width], own[:, width], own[:, width + 1], weights, rng, depth - tops.nodes[tree][top]["depth"], least)
        nodes["threshold"] = np.where(nodes["place"] >= 0, thresholds[nodes["place"], nodes["bin"]], 0.0)
        return pd.DataFrame({"tree": tree, "top": top} | {c.split()[0]: nodes[c.split()[0]] for c in GROWN.split(", ")[2:]})

    groups = sum(node["left"] < 0 and not node["leaf"] for nodes in tops.nodes for node in nodes)
    tasks = min(max(1, groups), max(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-n * trees // ROWS_PER_GROWTH)))
    sent = rows.mapInPandas(send, SENT).repartition(tasks, "tree", "top")
    share = F.size(F.filter(F.array(*map(F.lit, ends)), lambda end: end <= F.col("tree")))
    bottoms = sent.groupBy("tree", "top").applyInPandas(grow, GROWN).withColumn("share", share)
    bottoms.write.partitionBy("share").parquet(path)
    return rows.sparkSession.read.schema(bottoms.schema).parquet(path)


def numbered_tops(tops: Tops, sizes: dict[tuple[int, int], int], limits: list[list[float]]) -> tuple[list[tuple], list[tuple]]:
    """Numbers of the first node of each bottom, and the nodes above. Nodes of a tree are numbered without a gap, children after their parents."""
    starts, above = [], []
    for tree, nodes in enumerate(tops.nodes):
        own = [top for top, node in enumerate(nodes) if node["left"] >= 0 or node["leaf"]]
        number, free = {top: i for i, top in enumerate(own)}, len(own)
        for top in (top for top in range(len(nodes)) if top not in number):
            starts.append((tree, top, free))
            number[top], free = free, free + sizes[tree, top]
        for node, at in ((nodes[top], number[top]) for top in own):
            left, right = (number.get(node[side], -1) for side in ("left", "right"))
            threshold = limits[node["place"]][node["bin"]] if left >= 0 else 0.0
            above.append((tree, at, node["place"], threshold, left, right, node["gain"], node["n_0"], node["n_1"]))
    return starts, above


def whole_trees(bottoms: DataFrame, starts: list[tuple], above: list[tuple]) -> DataFrame:
    """Bottoms with their numbers moved to where they start, and the nodes above."""
    spark, columns = bottoms.sparkSession, [c for c in GROWN.split(", ") if c != "top int"]
    if any(start for *_, start in starts):
        start = F.broadcast(spark.createDataFrame(starts, "tree int, top int, start int"))
        moved = {c: F.when(F.col(c) >= 0, F.col(c) + F.col("start")).otherwise(F.col(c)) for c in ("node", "left", "right")}
        bottoms = bottoms.join(start, ["tree", "top"]).withColumns(moved)
    below = bottoms.select(*(c.split()[0] for c in columns))
    return below.unionByName(spark.createDataFrame(above, ", ".join(columns))) if above else below


def library_nodes(nodes: DataFrame, weights: np.ndarray, kind: str) -> DataFrame:
    """Nodes in the layout in which the library saves them; ``kind`` is that of its column ``nodeData``."""
    n = [F.col(f"n_{k}") * F.lit(float(weights[k])) for k in (0, 1)]
    inner, whole = F.col("left") >= 0, n[0] + n[1]
    split = F.struct(
        F.when(inner, F.col("place")).otherwise(-1).alias("featureIndex"),
        F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        F.col("node").alias("id"), (n[1] > n[0]).cast("double").alias("prediction"), (1 - (n[0] * n[0] + n[1] * n[1]) / (whole * whole)).alias("impurity"),
        F.array(*n).alias("impurityStats"), (F.col("n_0") + F.col("n_1")).alias("rawCount"), "gain", F.col("left").alias("leftChild"),
        F.col("right").alias("rightChild"), split.alias("split"),
    )
    return nodes.select(F.col("tree").alias("treeID"), node.cast(kind).alias("nodeData"))


def dealt_trees(trees: int, nodes: int) -> list[int]:
    """Numbers of trees of shares that have about ``NODES_PER_SHARE`` nodes, if a tree has so many."""
    parts = min(trees, max(1, -(-trees * nodes // NODES_PER_SHARE)))
    return [trees // parts + (i < trees % parts) for i in range(parts)]


def stored_forest(featured: DataFrame, features: str, label: str, weights: dict[int, float], trees: int, depth: int, least: int, seed: int) -> StoredForest:
    """Grow and store a forest; ``featured`` has the vector of features and the label, ``weights`` the weight of both classes."""
    spark = featured.sparkSession
    pattern, path, grown_path = (scratch_path(spark, name) for name in ("pattern", "forest", "grown"))
    settings = {"maxDepth": depth, "minInstancesPerNode": least, "seed": seed}

    def stump() -> None:
        model = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=1, maxDepth=0).fit(featured.select(features, label))
        model.write().save(pattern)

    with ThreadPool(min(MOST_VOTES, spark.sparkContext.defaultParallelism)) as pool:
        # What the library says of its models is taken from one without a split.
        said = pool.apply_async(inheritable_thread_target(spark)(stump))
        limits, by_class = bin_limits(featured.select(vector_to_array(features).alias("x"))), np.array([weights[0], weights[1]])
        rows, width = binned_rows(featured.withColumn("x", vector_to_array(features)), limits, label), len(limits)
        n = rows.count()
        # A node of twice the least rows may be split, and leaves of one class are joined.
        own = dealt_trees(trees, min(n // least, 2 ** (depth + 1)))
        tops = grow_tops(rows, n, width, by_class, trees, depth, least, seed)
        bottoms = grow_bottoms(rows, n, limits, by_class, own, tops, depth, least, seed, grown_path)
        sizes = {(r.tree, r.top): r.n for r in bottoms.groupBy("tree", "top").agg(F.count(F.lit(1)).alias("n")).collect()}
        starts, above = numbered_tops(tops, sizes, limits)
        said.get()
        data, about_trees, about = saved_parts(spark, pattern)
        kind, (number, text, weight), one = data.schema["nodeData"].dataType.simpleString(), about_trees.columns, about_trees.first()
        ends = list(accumulate(own))

        def save(k: int) -> None:
            first = ends[k] - own[k]
            mine = lambda found: [r for r in found if first <= r[0] < ends[k]]
            nodes = library_nodes(whole_trees(bottoms.where(F.col("share") == k), mine(starts), mine(above)), by_class, kind)
            table = spark.range(own[k]).select(F.col("id").cast("int").alias(number), F.lit(one[text]).alias(text), F.lit(1.0).alias(weight))
            whole = about | {"numTrees": own[k], "paramMap": about["paramMap"] | settings | {"numTrees": own[k]}}
            save_parts(spark, share_path(path, k), nodes.withColumn("treeID", (F.col("treeID") - first).cast("int")).coalesce(1), table.coalesce(1), whole)

        pool.map(inheritable_thread_target(spark)(save), range(len(own)), chunksize=1)
    return StoredForest(path, own)
