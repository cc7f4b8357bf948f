import datetime as dt
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from codetide.operators import features, split
from codetide.operators.features import build_dataset
from codetide.operators.snapshots import Windows
from codetide.plans import model_tables, training
from codetide.session import ensure_checkpoints, materialise, scratch, shared_dir
from codetide.sources import tables

RUN = dt.datetime(2024, 2, 8)
SMALL = {
    "logreg_baseline": {"maxIter": 20},
    "random_forest": {"numTrees": 5, "maxDepth": 4},
    "boosted_trees": {"maxIter": 40, "stepSize": 0.3, "maxDepth": 3, "patience": 5},
}


@pytest.fixture(scope="module")
def labelled(clean_events):
    return materialise(build_dataset(clean_events, Windows(min_events=1))[0], "labelled")


def test_no_repository_on_both_sides(labelled):
    sides = split.with_split(labelled).groupBy("repo_id").agg(F.count_distinct("is_test").alias("sides"))
    assert sides.where("sides > 1").count() == 0
    train, test = training.training_rows(labelled)
    assert train.count() + test.count() == labelled.count()
    assert train.select("repo_id").intersect(test.select("repo_id")).count() == 0
    flags = train.groupBy("repo_id").agg(F.count_distinct("is_validation").alias("flags"))
    assert flags.where("flags > 1").count() == 0


def test_classes_weigh_the_same(labelled):
    weights = split.class_weights(labelled).collect()
    totals = [r.class_rows * r.class_weight for r in weights]
    assert len(totals) == 2 and totals[0] == pytest.approx(totals[1]) == pytest.approx(labelled.count() / 2)


def test_unseen_languages_share_the_last_column(spark, labelled):
    rows = training.prepared(labelled)
    stages = training.feature_stages(["Unknown", "Go"])
    model = training.Pipeline(stages=stages).fit(rows)
    other = rows.limit(1).withColumn("language", F.lit("Zig"))
    vector = model.transform(other).select("language_vector").first()[0]
    assert vector.toArray().tolist() == [0.0, 0.0, 1.0]


def test_models_learn_a_rule_that_holds(labelled):
    from codetide.operators.evaluation import ranking_metrics, score_curve

    silent = (F.col("hours_since_last") > 100).cast("int")
    train, test = training.training_rows(labelled.withColumn("abandoned", silent))
    for name, model in training.fit_models(materialise(train, "train"), **SMALL).items():
        scored = training.score(model, test).withColumnRenamed("abandoned", "label")
        assert ranking_metrics(score_curve(scored)).first().roc_auc > 0.9, name


def test_patience():
    falling = [1.0, 0.9, 0.95, 0.8, 0.7]
    assert training.rounds_kept(falling, 2) == (5, False)
    assert training.rounds_kept([*falling, 0.75, 0.72], 2) == (5, True)
    assert training.rounds_kept([1.0, 1.1, 1.2, 0.1], 2) == (1, True)
    assert training.rounds_kept([1.0], 50) == (1, False)


@pytest.fixture(scope="module")
def many(spark):
    """6,000 rows of 3,000 repositories with features drawn by hash, for rules that need data to show."""
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    numbers = {c: draw(c, 200).cast("bigint") for c in features.NUMERIC_FEATURES}
    rows = spark.range(6000).withColumns({**numbers, "language": F.lit("Go")}).withColumns(
        {"repo_id": F.col("id") % 3000, "snapshot_date": F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 3000).cast("int") * 7)}
    )
    return materialise(rows, "many")


def trees_of(model):
    return [t.toDebugString.split("\n")[1:] for t in model.stages[-1].trees]


def test_boosting_goes_on_past_a_noisy_round_and_stops(many):
    """A rule of six columns needs many small trees; noise alone ends the growth early."""
    six = sum((F.col(c) for c in features.NUMERIC_FEATURES[1:6]), F.col(features.NUMERIC_FEATURES[0]))
    rule = (six > 600).cast("int")
    flipped = F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) == 0, 1 - rule).otherwise(rule)
    settings = {"maxIter": 30, "stepSize": 0.2, "maxDepth": 2, "patience": 10}
    train, _ = training.training_rows(many.withColumn("abandoned", flipped))
    model = training.boosted_trees(materialise(train, "train"), ["Go"], **settings)
    assert model.stages[-1].getNumTrees > 15
    noise = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(2)).cast("int")
    train, _ = training.training_rows(many.withColumn("abandoned", noise))
    noisy = training.boosted_trees(materialise(train, "train"), ["Go"], **settings | {"patience": 3, "maxDepth": 5})
    assert noisy.stages[-1].getNumTrees < 15


def test_a_cut_ensemble_is_a_shorter_fit(spark, many):
    noise = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(3)).cast("boolean").cast("int")
    train = materialise(training.training_rows(many.withColumn("abandoned", noise))[0].where("not is_validation"), "train")
    settings = {"stepSize": 0.2, "maxDepth": 3}
    long, short = (training.boosted_trees(train, ["Go"], maxIter=n, **settings) for n in (7, 4))
    cut = PipelineModel([*long.stages[:-1], model_tables.cut_to(spark, long.stages[-1], 4)])
    assert trees_of(cut) == trees_of(short) and cut.stages[-1].treeWeights == short.stages[-1].treeWeights
    assert training.score(cut, train).select("id", "probability").exceptAll(training.score(short, train).select("id", "probability")).count() == 0
    assert cut.stages[-1].getMaxIter() == 4


def test_rows_of_a_model_give_its_probabilities(spark, many):
    """Also with languages that are not listed, and from the rows alone."""
    rule = ((F.col("hours_since_last") > 100) != (F.col("language") == "Rust")).cast("int")
    mixed = many.withColumn("language", F.expr("element_at(array('Go', 'Rust', 'Zig', null), int(1 + id % 4))")).withColumn("abandoned", rule)
    train, test = training.training_rows(mixed)
    for name, model in training.fit_models(materialise(train, "train"), **SMALL).items():
        test = training.prepared(test)
        by_rows = model_tables.probability_by_rows(spark, model, test, "id").withColumnRenamed("probability", "by_rows")
        found = training.score(model, test).join(by_rows, "id").selectExpr("count(*) n", "max(abs(probability - by_rows)) apart", "stddev(by_rows) s").first()
        assert found.n == test.count() and found.apart < 1e-12 and found.s > 0.01, name
        rows = model_tables.model_rows(spark, model)
        assert rows.where("feature like 'language=%'").count() > 0 and not set(rows.columns) & {"nodeData", "place"}


def test_a_forest_is_fitted_in_shares(spark, many, monkeypatch):
    """Each fit reads few rows in one part, since every part holds the statistics of all nodes; the trees are as many as asked for, and differ."""
    fit, seen = training.RandomForestClassifier.fit, []

    def watched(self, rows):
        seen.append((self.getNumTrees(), self.getFeatureSubsetStrategy(), rows.rdd.getNumPartitions()))
        return fit(self, rows)

    monkeypatch.setattr(training.RandomForestClassifier, "fit", watched)
    noise = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(3)).cast("boolean").cast("int")
    train, test = training.training_rows(many.withColumn("abandoned", noise))
    model = training.random_forest(materialise(train, "train"), ["Go"], numTrees=7, maxDepth=5)
    assert sorted(seen) == [(1, "sqrt", 1), (2, "sqrt", 1), (2, "sqrt", 1), (2, "sqrt", 1)]
    forest = model.stages[-1]
    assert forest.getNumTrees == 7 == len(forest.trees) and len({str(t) for t in trees_of(model)}) == 7
    nodes = model_tables.tree_rows(spark, model)
    assert nodes.select("tree").distinct().count() == 7 and nodes.where("node = 0").count() == 7

    seen.clear()
    alone = training.random_forest(materialise(train, "train"), ["Go"], numTrees=1, maxDepth=5)
    assert seen == [(1, "auto", 1)] and alone.stages[-1].getNumTrees == 1


def test_rows_meet_trees_in_blocks_and_on_all_cores(spark, many):
    """A few stored rows lie in one part; the walk over them does not."""
    rule = (F.col("hours_since_last") > 100).cast("int")
    train, test = training.training_rows(many.withColumn("abandoned", rule))
    model = training.random_forest(materialise(train, "train"), ["Go"], **SMALL["random_forest"])
    one = materialise(training.prepared(test).coalesce(1), "one")
    twice = one.unionByName(one.where("id < 50")).withColumn("id", F.expr("if(id % 40 = 7, null, id)"))
    walked = model_tables.probability_by_rows(spark, model, twice, "id")
    assert "RoundRobinPartitioning(4)" in walked._jdf.queryExecution().toString()
    joins = walked.join(training.score(model, twice.where("id is not null")).select("id", "probability").distinct().toDF("id", "other"), "id")
    assert joins.count() == one.where("id % 40 <> 7").count() and joins.where("abs(probability - other) > 1e-12").count() == 0
    assert walked.where("id is null").count() == 1
    assert model_tables.probability_by_rows(spark, model, one.limit(0), "id").count() == 0


def test_checkpoints_outlive_a_run(spark):
    ensure_checkpoints(spark)
    folder = spark.sparkContext.getCheckpointDir()
    with scratch(spark):
        ensure_checkpoints(spark)
    assert spark.sparkContext.getCheckpointDir() == folder and "/run" not in folder
    assert Path(folder.removeprefix("file:")).is_dir()


def test_validation_rows_are_not_fitted(labelled):
    train, _ = training.training_rows(labelled)
    train = materialise(train, "train")
    wrong = train.withColumn("abandoned", F.when(F.col("is_validation"), 1 - F.col("abandoned")).otherwise(F.col("abandoned")))
    settings = {"maxIter": 3, "maxDepth": 2, "patience": 50}
    trees = [training.boosted_trees(t, ["Go"], **settings).stages[-1].trees[0].toDebugString for t in (train, wrong)]
    assert trees[0].split("\n")[1:] == trees[1].split("\n")[1:]


def test_logistic_gradient_with_its_penalty_is_zero(labelled):
    import numpy as np

    train, _ = training.training_rows(labelled)
    train = materialise(train, "train")
    model = training.logistic_regression(train, ["Go", "Rust"], tol=1e-12)
    rows = model.transform(split.with_class_weight(train)).select("scaled", "abandoned", "class_weight").collect()
    x, y, w = np.array([r.scaled.toArray() for r in rows]), np.array([r.abandoned for r in rows]), np.array([r.class_weight for r in rows])
    spread = x.std(axis=0)
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(spread[spread > 0], 1)
    assert w.sum() == pytest.approx(len(rows))
    beta = model.stages[-1].coefficients.toArray()
    error = w * (1 / (1 + np.exp(-(x @ beta + model.stages[-1].intercept))) - y)
    assert np.abs(x.T @ error + beta).max() < 1e-3 * len(rows) ** 0.5 and abs(error.sum()) < 1e-2


def test_training_run(spark, clean_events, tmp_path):
    tables.ensure_database(spark, "ml_run")
    folder = Path(shared_dir(spark).removeprefix("file:")) / "codetide"
    before = {p for run in folder.iterdir() for p in run.iterdir()}
    try:
        metrics, predictions = training.run_training(
            clean_events, Windows(min_events=1), RUN, model_path=str(tmp_path / "model"),
            predictions_table="ml_run.ml_repo_predictions", metrics_table="ml_run.ml_model_metrics",
            report_path=str(tmp_path / "report"), **SMALL,
        )
        rows = metrics.collect()
        assert {r.model for r in rows} == set(training.MODELS)
        assert max(r.roc_auc for r in rows) > 0.5
        assert all('"threshold"' in r.params and r.trained_at == RUN for r in rows)
        assert spark.table("ml_run.ml_model_metrics").count() == 3
        report = spark.read.json(str(tmp_path / "report" / "metrics")).collect()
        assert len(report) == 3 and report[0].feature_columns[0] == "events_total" and report[0].feature_columns[-1] == "language=other"
        assert spark.read.json(str(tmp_path / "report" / "roc")).where("tpr = 1 and fpr = 1").count() == 1
        scored = predictions.collect()
        assert scored and all(0 <= r.probability <= 1 and r.label is None for r in scored)
        assert {r.model for r in scored} == {max(rows, key=lambda r: r.pr_auc).model}
        assert PipelineModel.load(str(tmp_path / "model")).stages
        left = {p for run in folder.iterdir() for p in run.iterdir()} - before
        assert {p.name for p in left} <= {"kept"}
    finally:
        spark.sql("DROP DATABASE ml_run CASCADE")


def test_labels_that_become_known_are_stored(spark, clean_events):
    """A run on half the history leaves open labels; a later run fills those whose window has closed."""
    tables.ensure_database(spark, "ml_late")
    try:
        early = clean_events.where("created_at < timestamp'2024-01-24'")
        run = {"models": {"logreg_baseline": training.logistic_regression}, "predictions_table": "ml_late.ml_repo_predictions"}
        training.run_training(early, Windows(min_events=1), RUN, **run)
        first = spark.table("ml_late.ml_repo_predictions").where("label is null").select("snapshot_date").distinct().count()
        training.run_training(clean_events, Windows(min_events=1), RUN + dt.timedelta(days=7), **run)
        stored = spark.table("ml_late.ml_repo_predictions").where(F.col("trained_at") == F.lit(RUN))
        assert first and stored.where("label is not null").count() > 0
        facts = training.snapshot_rows(clean_events, Windows(min_events=1)).where("label_available")
        joined = stored.join(facts, ["snapshot_date", "repo_id"])
        assert joined.count() and joined.where("label <> abandoned").count() == 0
    finally:
        spark.sql("DROP DATABASE ml_late CASCADE")


def test_another_zone_is_refused(spark, clean_events):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(RuntimeError, match="UTC"):
            training.run_training(clean_events)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_too_little_history(spark, clean_events):
    with pytest.raises(ValueError, match="no events"):
        training.run_training(clean_events.limit(0))
    with pytest.raises(ValueError, match="no labelled snapshot"):
        training.run_training(clean_events.where("created_at < timestamp'2024-01-10'"))
