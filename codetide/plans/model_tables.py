"""Fitted models as rows, and scoring from those rows.

A linear model is a row per feature, an ensemble a row per node of its trees. The rows say all that a prediction needs, so another engine
can score with them, and a model can be read without the library that fitted it.
"""

from __future__ import annotations

import json
from itertools import accumulate
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.operators.features import NUMERIC_FEATURES
from codetide.session import materialise, scratch_path

LINEAR = "feature string, mean double, deviation double, coefficient double"
INTERCEPT = "(intercept)"
#: Depth that the library allows a tree.
DEEPEST = 30
#: Rows that walk down all trees, of a task and of a block at most on average; blocks of a task at least.
ROWS_PER_WALK, ROWS_PER_BLOCK, BLOCKS_PER_TASK = 10_000, 256, 4
#: Nodes of trees that are broadcast, or that meet the rows of one group, and rows of a group.
NODES_PER_MEETING, ROWS_PER_MEETING, MEETINGS_PER_TASK = 500_000, 100_000, 2
#: Rows of a task that scores with the trees of one share; shares at the same time at most, which the driver holds meanwhile.
ROWS_PER_VOTE, MOST_VOTES = 100_000, 6
#: Column that numbers the rows while they are scored.
ROW = "_scored_row"


def feature_names(languages: list[str]) -> list[str]:
    """Names of the places of the feature vector."""
    return [*NUMERIC_FEATURES, *(f"language={x}" for x in languages), "language=other"]


def languages_of(model: PipelineModel) -> list[str]:
    return next(list(s.labels) for s in model.stages if isinstance(s, StringIndexerModel))


def feature_values(languages: list[str]) -> dict[str, Column]:
    """Expression of each feature over prepared rows."""
    own = {x: (F.col("language") == x).cast("double") for x in languages}
    rest = (~F.col("language").isin(*languages)).cast("double") if languages else F.lit(1.0)
    return {c: F.col(c).cast("double") for c in NUMERIC_FEATURES} | {f"language={x}": v for x, v in own.items()} | {"language=other": rest}


def linear_rows(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """feature, mean, deviation, coefficient; a deviation of 0 takes a feature out."""
    *_, scaler, correction, regression = model.stages
    spread = [float(s) / float(c) for s, c in zip(scaler.std, correction.getScalingVec(), strict=True)]
    rows = [
        (name, float(mean), float(deviation), float(coefficient))
        for name, mean, deviation, coefficient in zip(
            feature_names(languages_of(model)), scaler.mean, spread, regression.coefficients, strict=True
        )
    ]
    return spark.createDataFrame([*rows, (INTERCEPT, 0.0, 1.0, float(regression.intercept))], LINEAR)


def saved_trees(data: DataFrame, trees: DataFrame) -> DataFrame:
    """tree, weight, node, place, threshold, left, right, value of a saved ensemble; a leaf has no place.

    A row goes left where its value is at most the threshold. Of a forest's leaf the value is the share of the positive class.
    """
    node = F.col("nodeData")
    split = node["split"]
    # Features of two values are split by the list of values that go left.
    listed = split["numCategories"] == 2
    swapped = listed & F.array_contains(split["leftCategoriesOrThreshold"], 1.0)
    inner = node["leftChild"] >= 0
    stats = node["impurityStats"]
    forest = F.size(stats) == 2
    return data.join(trees.toDF("treeID", "metadata", "weight"), "treeID").select(
        F.col("treeID").alias("tree"), "weight", node["id"].alias("node"),
        F.when(inner, split["featureIndex"]).alias("place"),
        F.when(inner, F.when(listed, F.lit(0.5)).otherwise(F.get(split["leftCategoriesOrThreshold"], F.lit(0)))).alias("threshold"),
        F.when(inner, F.when(swapped, node["rightChild"]).otherwise(node["leftChild"])).alias("left"),
        F.when(inner, F.when(swapped, node["leftChild"]).otherwise(node["rightChild"])).alias("right"),
        F.when(forest, F.get(stats, F.lit(1)) / (F.get(stats, F.lit(0)) + F.get(stats, F.lit(1)))).otherwise(node["prediction"]).alias("value"),
    )


def tree_rows(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Nodes of the model's trees, with the names of their features."""
    last = model.stages[-1]
    if isinstance(last, StoredForest):
        data, trees = last.parts(spark)
    else:
        path = scratch_path(spark, "trees")
        last.write().save(path)
        data, trees, _ = saved_parts(spark, path)
    names = F.array(*(F.lit(n) for n in feature_names(languages_of(model))))
    return saved_trees(data, trees).withColumn("feature", F.get(names, F.col("place"))).select(
        "tree", "weight", "node", "feature", "threshold", "left", "right", "value"
    )


def model_rows(spark: SparkSession, model: PipelineModel) -> DataFrame:
    return linear_rows(spark, model) if isinstance(model.stages[-1], LogisticRegressionModel) else tree_rows(spark, model)


def linear_probability(rows: DataFrame, terms: DataFrame, languages: list[str], *key: str) -> DataFrame:
    """The key columns and ``probability``: a row per feature, joined with its term and added up."""
    values = feature_values(languages)
    pairs = F.array(*(F.struct(F.lit(n).alias("feature"), v.alias("value")) for n, v in (values | {INTERCEPT: F.lit(1.0)}).items()))
    each = rows.select(*key, F.explode(pairs).alias("pair")).select(*key, "pair.*").join(F.broadcast(terms), "feature")
    scaled = F.when(F.col("deviation") == 0, 0.0).otherwise((F.col("value") - F.col("mean")) / F.col("deviation"))
    total = F.sum(F.col("coefficient") * scaled)
    return each.groupBy(*key).agg((1 / (1 + F.exp(-total))).alias("probability"))


def ensemble_probability(rows: DataFrame, nodes: DataFrame, languages: list[str], boosted: bool, *key: str) -> DataFrame:
    """The key columns and ``probability``: every row meets every tree, walks down it, and the leaves are added up."""
    values = feature_values(languages)
    place = F.nullif(F.array_position(F.array(*(F.lit(n) for n in values)), F.col("feature")).cast("int"), F.lit(0)).alias("at")
    placed = nodes.select("tree", "weight", "node", place, "threshold", "left", "right", "value")
    own = rows.select(*key, F.array(*values.values()).alias("x"))
    # The rows are long work for few bytes: their number decides on the tasks.
    n, size = rows.count(), nodes.count()
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_WALK))
    reached = blocks_reach(own, placed, n, tasks, *key) if size <= NODES_PER_MEETING else groups_reach(own, placed, n, size, tasks, len(values), *key)
    total = F.sum("total")
    probability = 1 / (1 + F.exp(-2 * total)) if boosted else total / F.sum("weight")
    return reached.groupBy(*key).agg(probability.alias("probability"))


def blocks_reach(own: DataFrame, nodes: DataFrame, n: int, tasks: int, *key: str) -> DataFrame:
    """The key columns, weight and weighted leaf of each row in each tree.

    The trees are a row each, and are broadcast. The join copies a tree for each row that meets it, and a tree may have thousands of nodes, so the rows
    meet it in blocks.
    """
    node = F.struct("node", "at", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    blocks = max(BLOCKS_PER_TASK * tasks, -(-n // ROWS_PER_BLOCK))
    block = F.pmod(F.xxhash64(*own.columns), F.lit(blocks)).alias("block")
    blocked = own.groupBy(block).agg(F.collect_list(F.struct(*own.columns)).alias("rows")).repartition(tasks)
    met = blocked.join(F.broadcast(trees))

    def leaf(x: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(F.col("nodes"), at)  # nodes are numbered from 0 without a gap
            return F.when(here["at"].isNull(), at).otherwise(
                F.when(F.element_at(x, here["at"]) <= here["threshold"], here["left"]).otherwise(here["right"])
            )

        return F.aggregate(F.sequence(F.lit(1), F.lit(DEEPEST)), F.lit(0), step)

    ends = F.transform("rows", lambda row: F.struct(*(row[c].alias(c) for c in key), F.get(F.col("nodes"), leaf(row["x"]))["value"].alias("value")))
    return met.select("weight", F.explode(ends).alias("end")).select(*(f"end.{c}" for c in key), "weight", (F.col("weight") * F.col("end.value")).alias("total"))


def groups_reach(own: DataFrame, nodes: DataFrame, n: int, size: int, tasks: int, width: int, *key: str) -> DataFrame:
    """The key columns, and weights and weighted leaves of each row added up over the trees of a part.

    No task gets all trees or all rows: each part of the trees meets each group of the rows by itself.
    """
    parts, groups = max(MEETINGS_PER_TASK * tasks, -(-size // NODES_PER_MEETING)), max(1, -(-n // ROWS_PER_MEETING))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    names = [f"key_{i}" for i in range(len(key))]

    def walk(rows: pa.Table, trees: pa.Table) -> pa.Table:
        x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)
        weight, total = np.zeros(len(x)), np.zeros(len(x))
        columns = trees.sort_by([("tree", "ascending"), ("node", "ascending")])
        tree, at, threshold, left, right, value, own_weight = (
            columns[c].fill_null(0).to_numpy() for c in ("tree", "at", "threshold", "left", "right", "value", "weight")
        )
        starts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) and len(x) else []
        for start in starts:  # nodes are numbered from 0 without a gap; a leaf has no place
            here, going = np.full(len(x), start), np.arange(len(x))
            while len(going := going[at[here[going]] > 0]):
                node = here[going]
                below = np.where(x[going, at[node] - 1] <= threshold[node], left[node], right[node])
                here[going] = start + below
            weight += own_weight[start]
            total += own_weight[start] * value[here]
        return pa.table([*(rows[c] for c in names), pa.array(weight), pa.array(total)], names=[*names, "weight", "total"])

    spread = own.select(*(F.col(c).alias(name) for c, name in zip(key, names, strict=True)), "x", F.pmod(F.xxhash64(*own.columns), F.lit(groups)).cast("int").alias("group"))
    spread = spread.withColumn("part", every(parts))
    met = nodes.withColumn("part", F.pmod("tree", F.lit(parts)).cast("int")).withColumn("group", every(groups))
    cells = 2 * parts * groups  # by hash, so more tasks than meetings keep them apart
    both = (side.repartition(cells, "part", "group").groupBy("part", "group") for side in (spread, met))
    kinds = ", ".join(f"{name} {own.schema[c].dataType.simpleString()}" for c, name in zip(key, names, strict=True))
    walked = next(both).cogroup(next(both)).applyInArrow(walk, f"{kinds}, weight double, total double")
    return walked.select(*(F.col(name).alias(c) for c, name in zip(key, names, strict=True)), "weight", "total")


def probability_by_rows(spark: SparkSession, model: PipelineModel, rows: DataFrame, *key: str) -> DataFrame:
    """What ``model`` predicts for prepared rows, computed from its rows alone."""
    languages, last = languages_of(model), model.stages[-1]
    if isinstance(last, LogisticRegressionModel):
        return linear_probability(rows, linear_rows(spark, model), languages, *key)
    if not isinstance(last, (GBTClassificationModel, RandomForestClassificationModel, StoredForest)):
        raise TypeError(f"no rows for {type(last).__name__}")
    return ensemble_probability(rows, tree_rows(spark, model), languages, isinstance(last, GBTClassificationModel), *key)


def saved_parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """Nodes and trees of a saved ensemble, the number of the tree first, and what is said of the whole."""
    data, trees = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/treesMetadata")
    return data.withColumnRenamed(data.columns[0], "treeID"), trees, json.loads(spark.read.text(f"{path}/metadata").first().value)


def save_parts(spark: SparkSession, path: str, data: DataFrame, trees: DataFrame, about: dict) -> str:
    data.write.parquet(f"{path}/data")
    trees.write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return path


def cut_to(spark: SparkSession, model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model with its first ``rounds`` trees: the saved one without the rest, loaded again. A fit of that length has the same trees."""
    whole = scratch_path(spark, "whole")
    model.write().save(whole)
    data, trees, about = saved_parts(spark, whole)
    about["numTrees"] = rounds
    about["paramMap"]["maxIter"] = rounds
    kept = data.where(F.col("treeID") < rounds), trees.where(F.col(trees.columns[0]) < rounds)
    return GBTClassificationModel.load(save_parts(spark, scratch_path(spark, "part"), *kept, about))


def share_path(path: str, share: int) -> str:
    """Where one of the forests of a stored one is saved."""
    return f"{path}/share={share}"


def joined_forest(spark: SparkSession, stored: StoredForest) -> RandomForestClassificationModel:
    """One forest of the library with the trees of all shares."""
    about = saved_parts(spark, share_path(stored.path, 0))[2]
    about["numTrees"] = about["paramMap"]["numTrees"] = stored.getNumTrees
    return RandomForestClassificationModel.load(save_parts(spark, scratch_path(spark, "joined"), *stored.parts(spark), about))


class StoredForest(Model, MLWritable, MLReadable):
    """A forest that is stored as shares of its trees, each saved as a forest of the library; no process holds it whole."""

    def __init__(self, path: str, shares: list[int]):
        super().__init__()
        self.path, self.shares = path, list(shares)

    @property
    def getNumTrees(self) -> int:
        return sum(self.shares)

    def parts(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """Nodes and trees of all shares, the trees numbered through."""
        before = F.array(*(F.lit(n - own) for n, own in zip(accumulate(self.shares), self.shares, strict=True)))

        def numbered(table: str) -> DataFrame:
            found = spark.read.option("basePath", self.path).parquet(*(f"{share_path(self.path, k)}/{table}" for k in range(len(self.shares))))
            first, *others, share = found.columns
            return found.select((F.col(first) + F.get(before, F.col(share))).cast("int").alias("treeID"), *others)

        return numbered("data"), numbered("treesMetadata")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``rawPrediction``, ``probability`` and ``prediction`` as the library's forest has them: shares score one by one, and their votes are added up."""
        spark = dataset.sparkSession
        rows = materialise(dataset.withColumn(ROW, F.monotonically_increasing_id()), "rows")
        featured = materialise(rows.select(ROW, "features").repartition(max(1, -(-rows.count() // ROWS_PER_VOTE))), "features")
        path = scratch_path(spark, "votes")

        def vote(share: int) -> None:
            model = RandomForestClassificationModel.load(share_path(self.path, share)).setProbabilityCol("").setPredictionCol("")
            votes = vector_to_array("rawPrediction")
            model.transform(featured).select(ROW, votes[0].alias("no"), votes[1].alias("yes")).write.parquet(share_path(path, share))

        with ThreadPool(min(MOST_VOTES, spark.sparkContext.defaultParallelism)) as pool:
            pool.map(inheritable_thread_target(spark)(vote), range(len(self.shares)), chunksize=1)
        raw = F.array(F.sum("no"), F.sum("yes"))
        votes = spark.read.schema(f"{ROW} bigint, no double, yes double, share int").parquet(path).groupBy(ROW).agg(raw.alias("raw"))
        shared = F.transform("raw", lambda x: x / (F.get("raw", F.lit(0)) + F.get("raw", F.lit(1))))
        return rows.join(votes, ROW).select(
            *dataset.columns, array_to_vector("raw").alias("rawPrediction"), array_to_vector(shared).alias("probability"),
            (F.get("raw", F.lit(1)) > F.get("raw", F.lit(0))).cast("double").alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    """Shares copied as they are, beside what the library writes of any model."""

    def __init__(self, forest: StoredForest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        spark, forest = self.sparkSession, self.forest
        DefaultParamsWriter.saveMetadata(forest, path, spark, {"shares": forest.shares})

        def copy(share: int) -> None:
            whence, to = share_path(forest.path, share), share_path(f"{path}/forest", share)
            save_parts(spark, to, *saved_parts(spark, whence))

        with ThreadPool(min(MOST_VOTES, spark.sparkContext.defaultParallelism)) as pool:
            pool.map(inheritable_thread_target(spark)(copy), range(len(forest.shares)), chunksize=1)


class _ForestReader(MLReader):
    def load(self, path: str) -> StoredForest:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        return StoredForest(f"{path}/forest", metadata["shares"])
