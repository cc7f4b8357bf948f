"""Forests that grow in tasks: their trees, their stored form, their votes."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from codetide.operators import features, trees
from codetide.operators.evaluation import ranking_metrics, score_curve
from codetide.plans import forest, model_tables, training
from codetide.session import materialise

EVEN = np.array([1.0, 1.0])


@pytest.fixture(scope="module")
def sides(spark):
    """4,000 rows of 2,000 repositories; a rule of two columns, with noise."""
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    numbers = {c: draw(c, 3 if c == "stars" else 200).cast("bigint") for c in features.NUMERIC_FEATURES}
    rule = ((F.col("pushes") > 100) != F.col("language").eqNullSafe("Rust")).cast("int")
    rows = spark.range(4000).withColumns({**numbers, "language": F.expr("element_at(array('Go', 'Rust', 'Zig', null), int(1 + id % 4))")}).withColumns({
        "repo_id": F.col("id") % 2000, "snapshot_date": F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 2000).cast("int") * 7),
        "abandoned": F.when(draw("noise", 10) == 0, 1 - rule).otherwise(rule),
    })
    train, test = training.training_rows(materialise(rows, "rows"))
    return materialise(train, "train"), materialise(test, "test")


@pytest.fixture(params=[200_000, 700], ids=["whole", "tops"])
def grown(request, spark, sides, monkeypatch):
    """A forest that is not left to the library; once with trees whose tops are split over all parts of the rows."""
    fit, seen = training.RandomForestClassifier.fit, []

    def watched(self, rows):
        seen.append(self.getNumTrees() * 2 ** self.getMaxDepth())
        return fit(self, rows)

    monkeypatch.setattr(training.RandomForestClassifier, "fit", watched)
    monkeypatch.setattr(training, "GROWN_BY_LIBRARY", 5_000)
    monkeypatch.setattr(forest, "ROWS_GROWN", request.param)
    monkeypatch.setattr(forest, "NODES_PER_SHARE", 2_000)
    model = training.random_forest(sides[0], ["Go", "Rust"], numTrees=7, maxDepth=14)
    assert max(seen) == 1  # the library has fitted nothing but a pattern without a split
    return model


def test_a_large_forest_is_not_held_by_the_driver(spark, sides, grown):
    last = grown.stages[-1]
    assert isinstance(last, model_tables.StoredForest) and last.getNumTrees == 7 and len(last.shares) > 1
    data = last.parts(spark)[0]
    nodes = {(r.treeID, r.nodeData.id): r.nodeData for r in data.collect()}
    n = sides[0].count()
    for tree in range(7):
        own = [nodes[tree, i] for i in range(sum(t == tree for t, _ in nodes))]  # numbered without a gap
        assert abs(own[0].rawCount - n) < 5 * n**0.5
        depth = {0: 0}
        for i, node in enumerate(own):
            if node.leftChild < 0:
                assert node.rawCount >= training.FOREST_MIN_LEAF
                continue
            left, right = own[node.leftChild], own[node.rightChild]
            assert i < node.leftChild and i < node.rightChild and left.rawCount + right.rawCount == node.rawCount and node.gain > 0
            assert np.allclose(np.add(left.impurityStats, right.impurityStats), node.impurityStats)
            assert max(left.leftChild, right.leftChild) >= 0 or left.prediction != right.prediction
            depth[node.leftChild] = depth[node.rightChild] = depth[i] + 1
        assert len(depth) == len(own) and 5 < max(depth.values()) <= 14
    assert len({(nodes[t, 0].split.featureIndex, nodes[t, 0].rawCount) for t in range(7)}) > 3


@pytest.mark.parametrize("grown", [700], indirect=True, ids=["tops"])
def test_votes_are_those_of_one_forest_of_the_library(spark, sides, grown, tmp_path, monkeypatch):
    """The stored forest, the joined one, the saved one and the rows of the model agree, also for rows that come twice and keys that are null."""
    one = training.prepared(sides[1])
    test = one.unionByName(one.where("id % 50 = 0")).withColumn("other", F.col("id")).withColumn("id", F.expr("if(id % 40 = 7, null, id)"))
    scored = training.score(grown, test).select("id", "other", "probability")
    assert scored.count() == test.count()
    assert ranking_metrics(score_curve(training.score(grown, sides[1]).withColumnRenamed("abandoned", "label"))).first().roc_auc > 0.8

    joined = PipelineModel([*grown.stages[:-1], model_tables.joined_forest(spark, grown.stages[-1])])
    grown.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert isinstance(loaded.stages[-1], model_tables.StoredForest)
    distinct = scored.distinct()
    for other in (joined, loaded):
        again = training.score(other, test).select("other", F.col("probability").alias("again")).distinct()
        found = distinct.join(again, "other").selectExpr("count(*) n", "max(abs(probability - again)) apart").first()
        assert found.n == distinct.count() and found.apart < 1e-12
    whole, stored = (m.transform(training.prepared(sides[1])).select("id", "prediction", "rawPrediction", "probability") for m in (joined, grown))
    assert whole.columns == stored.columns and whole.select("id", "prediction").exceptAll(stored.select("id", "prediction")).count() == 0

    for most in (900, 1_000_000):
        monkeypatch.setattr(model_tables, "NODES_PER_MEETING", most)
        monkeypatch.setattr(model_tables, "ROWS_PER_MEETING", 300)
        by_rows = model_tables.probability_by_rows(spark, grown, test, "other").withColumnRenamed("probability", "by_rows")
        found = distinct.join(by_rows, "other").selectExpr("count(*) n", "max(abs(probability - by_rows)) apart").first()
        assert found.n == distinct.count() and found.apart < 1e-12
        null = model_tables.probability_by_rows(spark, grown, test, "id")
        assert null.where("id is null").count() == 1
        assert model_tables.probability_by_rows(spark, grown, test.limit(0), "id").count() == 0


def test_rows_are_drawn_with_repeats():
    drawn = trees.draws(np.arange(200_000), 3, 42)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03) and (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    assert (trees.draws(np.arange(100, 200), 3, 42) == drawn[100:200]).all()
    assert abs(np.corrcoef(drawn, trees.draws(np.arange(200_000), 4, 42))[0, 1]) < 0.02


def gini(n, weights):
    share = n * weights / (n * weights).sum()
    return 1 - (share**2).sum()


def test_the_best_split_is_taken(monkeypatch):
    """Against every split of every feature, one by one; weights of the classes and copies of rows count."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(trees, "tried_features", lambda _, nodes, width: np.tile(np.arange(width), (nodes, 1)))
    for weights in (EVEN, np.array([0.6, 2.5])):
        x, y, copies = rng.integers(0, 8, (60, 4)).astype(np.uint8), rng.integers(0, 2, 60), rng.integers(1, 4, 60).astype(np.uint8)
        count = lambda inside: np.array([copies[inside & (y == k)].sum() for k in (0, 1)], float)  # noqa: E731, B023
        everything = np.ones(60, bool)
        gains = {}
        for f in range(4):
            for b in range(8):
                a, c = count(x[:, f] <= b), count(x[:, f] > b)
                if min(a.sum(), c.sum()) >= 3:
                    share = (a * weights).sum() / (count(everything) * weights).sum()
                    gains[f, b] = gini(count(everything), weights) - share * gini(a, weights) - (1 - share) * gini(c, weights)
        tree = trees.grown(x, y, copies, weights, rng, 30, 3)
        assert tree["gain"][0] == pytest.approx(max(gains.values())) == pytest.approx(gains[tree["place"][0], tree["bin"][0]])
        leaves = tree["left"] < 0
        assert (tree["n_0"] + tree["n_1"])[leaves].sum() == copies.sum() and (tree["n_0"] + tree["n_1"]).min() >= 3


def test_trees_without_a_split():
    x, rng = np.zeros((9, 3), np.uint8), np.random.default_rng(1)
    for y, depth in ((np.ones(9), 30), (np.arange(9) % 2, 30), (np.arange(9) % 2, 0)):
        tree = trees.grown(x, y, np.ones(9, np.uint8), EVEN, rng, depth, 3)
        assert len(tree["node"]) == 1 and tree["left"][0] == -1 and tree["n_1"][0] == y.sum()


def test_limits_of_bins(spark):
    rows = spark.range(1000).selectExpr("array(double(id), double(id % 3), 7.0D) as x")
    limits = forest.bin_limits(rows)
    assert limits[1:] == [[0.5, 1.5], []] and len(limits[0]) == forest.BINS - 1 and np.allclose(np.diff(limits[0]), 1000 / forest.BINS, atol=2)
