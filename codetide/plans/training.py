"""Abandonment models: fit on labelled snapshots, evaluate, choose, score, publish.

Rows go from the event table to the fitted model without passing through the driver; what it
collects is the list of at most 15 languages and one row of metrics per model.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetide.functions.time import instant
from codetide.operators.evaluation import best_model, evaluate, metrics_rows, roc_curve, score_curve
from codetide.operators.features import NUMERIC_FEATURES, labelled, snapshot_rows, unlabelled
from codetide.operators.snapshots import Windows
from codetide.operators.split import (
    SPLIT_SEED,
    class_weights,
    language_or_unknown,
    top_languages,
    with_class_weight,
    with_split,
    with_validation,
)
from codetide.plans.forest import stored_forest
from codetide.plans.model_tables import StoredForest, cut_to, joined_forest, model_rows, share_path
from codetide.session import ensure_checkpoints, materialise, require_utc, scratch, scratch_path
from codetide.sources.tables import append_table, overwrite_partitions

LABEL, WEIGHT, FEATURES = "abandoned", "class_weight", "features"

# Hyperparameters of the three models.
LOGREG_MAX_ITER, LOGREG_C = 2000, 1.0
FOREST_TREES, FOREST_MIN_LEAF = 300, 3
BOOST_ITERATIONS, BOOST_RATE, BOOST_DEPTH, BOOST_PATIENCE, BOOST_BINS = 500, 0.05, 6, 50, 254

# The library's limit; the size of a leaf ends the growth before.
FOREST_DEPTH = 30

# Boosting is fitted with so many rounds at first, which shows an early least loss and the patience after it; then with four times the patience; then with all.
BOOST_FIRST = 64

#: Rows of a task when trees are fitted: many for large sets; for small ones enough to keep the cores busy.
ROWS_PER_TASK, FEWEST_ROWS = 100_000, 500

#: Forests that are fitted at the same time at most; what their seeds are apart, since a seed and the number of a part of the rows are added up.
MOST_FITS, SEED_STEP = 32, 1_000_003

#: Rows times trees of a forest that the library fits: it holds all nodes on the driver. What may differ in a larger one; its least rows.
GROWN_BY_LIBRARY, GROWN_WITH, FEWEST_GROWN = 500_000, {"numTrees", "maxDepth", "minInstancesPerNode", "seed"}, 1_000


def feature_stages(languages: list[str]) -> list:
    """Language one-hot and the numeric columns as one vector.

    Languages outside the list, also ones first met when scoring, share the extra last
    index: that is the bucket for all others. The list is fixed when training.
    """
    index = StringIndexerModel.from_labels(
        languages, inputCol="language", outputCol="language_index", handleInvalid="keep"
    )
    one_hot = OneHotEncoder(inputCol="language_index", outputCol="language_vector", dropLast=False)
    vector = VectorAssembler(inputCols=[*NUMERIC_FEATURES, "language_vector"], outputCol=FEATURES)
    return [index, one_hot, vector]


def population_scaler(languages: list[str], n: int) -> list:
    """Columns to mean 0 and population deviation 1; the library's scaler divides by the sample deviation."""
    scaler = StandardScaler(inputCol=FEATURES, outputCol="sample_scaled", withMean=True, withStd=True)
    width = len(NUMERIC_FEATURES) + len(languages) + 1
    correction = Vectors.dense([(n / (n - 1)) ** 0.5 if n > 1 else 1.0] * width)
    return [scaler, ElementwiseProduct(scalingVec=correction, inputCol="sample_scaled", outputCol="scaled")]


def logistic_regression(train: DataFrame, languages: list[str], **params) -> PipelineModel:
    """Balanced logistic regression with an L2 penalty.

    The library divides the weighted loss by the sum of weights, which balanced weights make the number of rows; a penalty of half the
    squared coefficients beside ``LOGREG_C`` times the summed loss is therefore ``1 / (C n)`` here.
    """
    n = train.count()
    settings = {"maxIter": LOGREG_MAX_ITER, "regParam": 1.0 / (LOGREG_C * max(1, n)), "elasticNetParam": 0.0, **params}
    model = LogisticRegression(
        featuresCol="scaled", labelCol=LABEL, weightCol=WEIGHT, standardization=False, **settings
    )
    return Pipeline(stages=[*feature_stages(languages), *population_scaler(languages, n), model]).fit(
        with_class_weight(train)
    )


def _dealt(rows: DataFrame, fewest: int = FEWEST_ROWS) -> DataFrame:
    """Stored rows in as many parts as their number is worth: every level of a tree is a job over all of them."""
    n = rows.count()
    parts = max(-(-n // ROWS_PER_TASK), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // fewest)), 1)
    return materialise(rows.repartition(parts, "repo_id", "snapshot_date"), "fit_rows")


def shares(trees: int, parts: int) -> list[int]:
    """``trees`` dealt out to ``parts`` forests, one tree each at least."""
    parts = max(1, min(trees, parts))
    return [trees // parts + (i < trees % parts) for i in range(parts)]


def random_forest(train: DataFrame, languages: list[str], **params) -> PipelineModel:
    """A forest that the library fits, or for more rows one that grows in tasks and stays stored (``plans.forest``).

    The library fits several at the same time, each with a share of the trees and draws of its own, which are joined to one.
    Every task of a level holds the statistics of all nodes of the level, however few rows it has, and sends them on. So the cores are kept busy
    by trees, which share nothing, and the rows are in as few parts as tasks can read.
    The node that a row has reached in each tree is kept with the row, so a level does not walk down all trees again.
    """
    settings = {
        "numTrees": FOREST_TREES,
        "minInstancesPerNode": FOREST_MIN_LEAF,
        "maxDepth": FOREST_DEPTH,
        "maxMemoryInMB": 1024,
        "cacheNodeIds": True,
        "seed": SPLIT_SEED,
        **params,
    }
    spark = train.sparkSession
    ensure_checkpoints(spark)
    weights = {r[LABEL]: r[WEIGHT] for r in class_weights(train).collect() if r[LABEL] is not None}
    n = train.count()
    grows = n * settings["numTrees"] > GROWN_BY_LIBRARY and n >= FEWEST_GROWN and set(params) <= GROWN_WITH and set(weights) == {0, 1}
    rows = _dealt(with_class_weight(train), FEWEST_ROWS if grows else ROWS_PER_TASK)
    stages = Pipeline(stages=feature_stages(languages)).fit(rows)
    featured = stages.transform(rows).select(FEATURES, LABEL, WEIGHT)
    if grows:
        grown = (settings[name] for name in ("numTrees", "maxDepth", "minInstancesPerNode", "seed"))
        return PipelineModel([*stages.stages, stored_forest(featured, FEATURES, LABEL, weights, *grown)])
    own = shares(settings["numTrees"], min(MOST_FITS, spark.sparkContext.defaultParallelism))

    def fit(part: int):
        drawn = settings | {"numTrees": own[part], "seed": settings["seed"] + part * SEED_STEP}
        if len(own) > 1:  # for one tree alone the library would draw no features
            drawn = {"featureSubsetStrategy": "sqrt"} | drawn
        return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, **drawn).fit(featured)

    if len(own) == 1:
        return PipelineModel([*stages.stages, fit(0)])
    path = scratch_path(spark, "forest")
    with ThreadPool(len(own)) as pool:
        save = inheritable_thread_target(spark)(lambda part: fit(part).write().save(share_path(path, part)))
        pool.map(save, range(len(own)), chunksize=1)
    return PipelineModel([*stages.stages, joined_forest(spark, StoredForest(path, own))])


def rounds_kept(losses: list[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the least validation loss, and whether ``patience`` rounds without a lower one followed."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def boosted_trees(train: DataFrame, languages: list[str], **params) -> PipelineModel:
    """Boosting on the rows that are not ``is_validation``, ended by the loss on those that are.

    A longer run with the same seed begins with the trees of a shorter one, so the model is one that was cut to the rounds up to the least loss
    before ``patience`` rounds without improvement. Nothing is fitted again for that; only where ``BOOST_FIRST`` rounds, then four times the patience, do
    not show it, a longer run is fitted.
    """
    most = params.pop("maxIter", BOOST_ITERATIONS)
    patience = params.pop("patience", BOOST_PATIENCE)
    settings = {
        "stepSize": BOOST_RATE,
        "maxDepth": BOOST_DEPTH,
        "maxBins": BOOST_BINS,
        "maxMemoryInMB": 1024,
        "seed": SPLIT_SEED,
        **params,
    }
    spark = train.sparkSession
    ensure_checkpoints(spark)
    fitted = train.where(~F.col("is_validation"))
    weights = class_weights(fitted).drop("class_rows")
    stages = Pipeline(stages=feature_stages(languages)).fit(train)
    weighted = stages.transform(_dealt(train.join(F.broadcast(weights), LABEL), 4 * FEWEST_ROWS)).select(FEATURES, LABEL, WEIGHT, "is_validation")
    own, held = weighted.where(~F.col("is_validation")), weighted.where(F.col("is_validation"))

    def fit(rounds: int):
        return GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxIter=rounds, **settings).fit(own)

    if held.isEmpty():
        return PipelineModel([*stages.stages, fit(most)])
    for rounds in sorted({min(n, most) for n in (BOOST_FIRST, 4 * patience, most)}):
        model = fit(rounds)
        keep, over = rounds_kept(model.evaluateEachIteration(held), patience)
        if over:
            break
    return PipelineModel([*stages.stages, model if keep == rounds else cut_to(spark, model, keep)])


Fit = Callable[..., PipelineModel]

MODELS: dict[str, Fit] = {
    "logreg_baseline": logistic_regression,
    "random_forest": random_forest,
    "boosted_trees": boosted_trees,
}


def prepared(rows: DataFrame) -> DataFrame:
    """Rows as the feature stages expect them: language filled, numbers as doubles."""
    numbers = {c: F.col(c).cast("double") for c in NUMERIC_FEATURES}
    return rows.withColumns({"language": language_or_unknown(), **numbers})


def training_rows(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows, part of them marked for validation, and test rows. Each model weighs the rows that it fits."""
    sides = with_split(prepared(known))
    return with_validation(sides.where(~F.col("is_test"))), sides.where(F.col("is_test"))


def language_list(rows: DataFrame) -> list[str]:
    """At most 15 names."""
    return [row.language for row in top_languages(rows).collect()]


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``probability`` of being abandoned."""
    scored = model.transform(prepared(rows))
    return scored.withColumn("probability", vector_to_array("probability")[1]).select(
        *rows.columns, "probability"
    )


def known_label() -> Column:
    """1 or 0 once the outcome window has closed, else null."""
    return F.when(F.col("label_available"), (F.col("future_events") == 0).cast("int"))


def predictions(scored: DataFrame, model: str, threshold: float, trained_at: dt.datetime) -> DataFrame:
    """Scored snapshot rows in the layout of the prediction table (double precision kept)."""
    return scored.select(
        "snapshot_date",
        "repo_id",
        "repo_name",
        "language",
        "probability",
        (F.col("probability") >= threshold).cast("int").alias("prediction"),
        known_label().alias("label"),
        F.lit(model).alias("model"),
        instant(trained_at).alias("trained_at"),
    )


def backfilled_labels(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored predictions with the labels that have become known since, by snapshot and repo."""
    facts = rows.select("snapshot_date", "repo_id", known_label().alias("fact"))
    return (
        stored.join(facts, ["snapshot_date", "repo_id"], "left")
        .withColumn("label", F.coalesce("fact", "label"))
        .select(*stored.columns)
    )


def backfill_labels(table: str, rows: DataFrame) -> None:
    """Write the labels that have become known into the stored predictions.

    Only the snapshots whose outcome window has closed and that still have open labels are read and overwritten.
    """
    spark = rows.sparkSession
    stored = spark.table(table)
    # Snapshots are as many as the history has strides; as literals they prune the partitions of the table.
    closed = _dates(rows.where("label_available"))
    due = _dates(stored.where(F.col("snapshot_date").isin(closed) & F.col("label").isNull()))
    on_due = F.col("snapshot_date").isin(due)
    overwrite_partitions(materialise(backfilled_labels(stored.where(on_due), rows.where(on_due)), "backfilled"), table)


def _dates(rows: DataFrame) -> list[dt.date]:
    return sorted(r.snapshot_date for r in rows.select("snapshot_date").distinct().collect())


def fit_models(
    train: DataFrame, models: Mapping[str, Fit] | None = None, **params: dict
) -> dict[str, PipelineModel]:
    """Fit each model; ``params`` gives settings by model name."""
    languages = language_list(train)
    chosen = MODELS if models is None else models
    return {name: fit(train, languages, **params.get(name, {})) for name, fit in chosen.items()}


def run_training(
    events: DataFrame,
    windows: Windows = Windows(),
    trained_at: dt.datetime | None = None,
    models: Mapping[str, Fit] | None = None,
    model_path: str | None = None,
    predictions_table: str | None = None,
    metrics_table: str | None = None,
    report_path: str | None = None,
    **params: dict,
) -> tuple[DataFrame, DataFrame]:
    """Build the data set, fit, evaluate, choose by average precision, score, publish.

    Returns metrics history rows and predictions. The feature rows and the test scores are
    written to the shared folder once, since every model and metric reads them again; what is not a result is removed at the end.
    The report folder gets the metrics, the feature columns, the best model's ROC points and the model itself as rows. Labels that have become known are
    written into the stored predictions.
    """
    spark = events.sparkSession
    require_utc(spark)
    with scratch(spark) as keep:
        metrics, chosen = _training(
            events, windows, trained_at, models, model_path, predictions_table, metrics_table, report_path, params
        )
        return keep(metrics, "metrics"), keep(chosen, "predictions")


def _training(
    events: DataFrame, windows: Windows, trained_at: dt.datetime | None, models: Mapping[str, Fit] | None, model_path: str | None,
    predictions_table: str | None, metrics_table: str | None, report_path: str | None, params: dict,
) -> tuple[DataFrame, DataFrame]:
    now = trained_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    spark = events.sparkSession
    if events.isEmpty():
        raise ValueError("no events: run the ETL first")
    rows = materialise(snapshot_rows(events, windows), "snapshot_rows")
    known, open_rows = labelled(rows), unlabelled(rows)
    if known.isEmpty():
        raise ValueError(
            f"no labelled snapshot: {windows.obs_days} + {windows.future_days} days of history are needed"
        )
    train, test = training_rows(known)
    train = materialise(train, "train")

    fitted = fit_models(train, models, **params)
    scores, evaluated = {}, []
    for name, model in fitted.items():
        scores[name] = materialise(
            score(model, test).select("snapshot_date", "repo_id", "probability", F.col(LABEL).alias("label")),
            f"scored_{name}",
        )
        evaluated.append(materialise(evaluate(scores[name], name), f"metrics_{name}"))
    results = evaluated[0]
    for other in evaluated[1:]:
        results = results.unionByName(other)
    metrics = metrics_rows(results, known, instant(now))

    best = best_model(results).select("model", "threshold").first()
    chosen = predictions(score(fitted[best.model], open_rows), best.model, best.threshold, now)
    if model_path:
        fitted[best.model].write().overwrite().save(model_path)
    if report_path:
        columns = F.array(*[F.lit(c) for c in NUMERIC_FEATURES], *[F.lit(f"language={x}") for x in language_list(train)], F.lit("language=other"))
        metrics.withColumn("feature_columns", columns).write.mode("overwrite").json(f"{report_path}/metrics")
        model_rows(spark, fitted[best.model]).write.mode("overwrite").json(f"{report_path}/model")
        points = roc_curve(score_curve(scores[best.model])).withColumn("model", F.lit(best.model))
        points.write.mode("overwrite").json(f"{report_path}/roc")
    if metrics_table:
        append_table(metrics, metrics_table)
    if predictions_table:
        append_table(chosen, predictions_table)
        backfill_labels(predictions_table, rows)
        chosen = spark.table(predictions_table).where(F.col("trained_at") == instant(now))
    return metrics, chosen
