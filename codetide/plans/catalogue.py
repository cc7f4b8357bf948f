"""Every operator and report as a named query over the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetide.functions.time import in_period, instant
from codetide.operators import cleaning, evaluation, features, marts, split
from codetide.operators.snapshots import (
    Windows,
    assign_snapshots,
    data_bounds,
    snapshot_calendar,
)
from codetide.plans import aggregates, incremental, model_tables, reports, risk_reports, training
from codetide.session import materialise, scratch_path
from codetide.sources import archives, manifest
from codetide.sources.clickstream import (
    cut_archive,
    landed_all,
    landed_before_last_day,
    raw_events,
    raw_lines,
    read_clickstream,
    store_archives,
    untidy_lines,
)
from codetide.sources.tables import ensure_database
from codetide.streaming.archives import land_new_archives

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.datetime(2026, 1, 1)
LATE_DAY = "2024-01-12"
PERIOD = (dt.date(2024, 1, 5), dt.date(2024, 1, 24))
WINDOWS = Windows()
EARLIER_RUN, LAST_RUN = dt.datetime(2024, 2, 1, 6), dt.datetime(2024, 2, 8, 6)
# A formula in place of a trained model, so that the reports over its output can be checked.
RECENCY_THRESHOLD = 0.25
METRIC_DECIMALS = 9


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(read_clickstream(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_events(raw(spark, sf_dir), AS_OF)


def _stored_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events as a stored table, for queries that read them several times."""
    return materialise(clean(spark, sf_dir), "events")


# --- sources -----------------------------------------------------------------------------


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    lines = raw_lines(read_clickstream(spark, sf_dir)).select("value")
    lines.write.option("compression", "gzip").text(path)
    return archives.read_archives(spark, path).select(
        "id", "type", F.col("actor.id").alias("actor_id"), F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"),
        F.col("payload.action").alias("action"), F.col("payload.size").alias("size"),
        F.col("payload.forkee.language").alias("fork_language"),
        F.col("payload.pull_request.base.repo.language").alias("base_language"),
        "created_at",
    )


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of real archive files, one of them badly named, with blank, padded and broken lines."""
    folder = store_archives(untidy_lines(read_clickstream(spark, sf_dir)), scratch_path(spark, "landing"))
    return archives.land_lines(archives.read_lines(spark, folder))


def archive_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines landed of each archive, the largest of which was cut in the transfer, with the reason why it is set aside."""
    lines = untidy_lines(read_clickstream(spark, sf_dir))
    folder = store_archives(lines, scratch_path(spark, "arriving"))
    largest = lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("n")).where(F.col("file_name").rlike(archives.ARCHIVE_NAME))
    cut_archive(spark, folder, largest.orderBy(F.desc("n"), "file_name").first().file_name)
    database = f"codetide_{uuid.uuid4().hex}"
    ensure_database(spark, database)
    try:
        land_new_archives(spark, folder, database, scratch_path(spark, "state"))
        landed = archives.landed_counts(spark.table(f"{database}.events_raw"))
        aside = spark.table(f"{database}.archives_quarantined").select("source_file", "reason")
        both = landed.join(aside, "source_file", "full").select("source_file", F.coalesce("lines", F.lit(0)).alias("lines"), "reason")
        return materialise(both, "quarantine")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def incremental_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events after a load of all archives but those of one middle day, and then of that day."""
    lines = untidy_lines(read_clickstream(spark, sf_dir))
    database = f"codetide_{uuid.uuid4().hex}"
    late = F.col("file_name").startswith(LATE_DAY)
    ensure_database(spark, database)
    try:
        incremental.merge_arrivals(lines.where(~late), database, AS_OF)
        incremental.merge_arrivals(lines.where(late), database, AS_OF)
        return materialise(spark.table(f"{database}.events_parsed").drop("event_date"), "incremental")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.col("ts").cast("timestamp")
    return read_clickstream(spark, sf_dir).select(archives.archive_name(hour).alias("file_name")).distinct()


def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landed_before_last_day(read_clickstream(spark, sf_dir))
    return archives.not_landed(_raw_files(spark, sf_dir), landed).select("file_name", "source_file")


def landed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.landed_counts(landed_all(read_clickstream(spark, sf_dir)))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_clickstream(spark, sf_dir).agg(
        F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day")
    )


def hour_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.hours_of_days(_days(spark, sf_dir))


def hour_manifest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many hours from 16:00 of the first day on as the stream has hours with events."""
    clicks = read_clickstream(spark, sf_dir)
    start = clicks.agg(
        F.to_date(F.min("ts")).alias("first_day"),
        F.lit(16).alias("start_hour"),
        F.count_distinct(F.date_trunc("hour", F.col("ts").cast("timestamp"))).cast("int").alias("n_hours"),
    )
    return manifest.hours_from(start)


def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landed_before_last_day(read_clickstream(spark, sf_dir))
    return manifest.missing_hours(hour_manifest(spark, sf_dir), landed)


def backfill_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landed_before_last_day(read_clickstream(spark, sf_dir))
    return manifest.backfill_progress(hour_manifest(spark, sf_dir), landed)


# --- cleaning ----------------------------------------------------------------------------


def flt_target_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.target_events(raw(spark, sf_dir)).select("id", "type", "created_at")


def flt_date_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = cleaning.parse_time(raw(spark, sf_dir))
    return cleaning.plausible_time(timed, AS_OF).select("id", "created_at")


def flt_bot_pushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.without_bot_pushes(raw(spark, sf_dir)).select(
        "id", "type", F.col("payload.size").alias("size")
    )


def resolve_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("id", cleaning.resolved_language().alias("language"))


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = cleaning.parse_time(raw(spark, sf_dir))
    return cleaning.dedup_events(cleaning.flatten(timed))


def flt_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_period(clean(spark, sf_dir), "created_at", *PERIOD).select("event_id", "created_at")


# --- marts and activity reports ----------------------------------------------------------


def mart_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.language_mart(clean(spark, sf_dir))


def mart_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.repo_mart(clean(spark, sf_dir))


def mart_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hourly_mart(clean(spark, sf_dir))


def mart_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.merge_mart(
        mart_repo(spark, sf_dir),
        ["hour", "repo_id"],
        ["total_events", "stars_gained", "forks_gained", "total_commits"],
    )


def _over_hourly(report: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: report(mart_hourly(spark, sf_dir), *PERIOD)


def _over_events(report: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: report(clean(spark, sf_dir), *PERIOD, *args)


def rpt_kpi_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The period's figures from hourly sketches, and whether the estimates are within three deviations of the exact numbers."""
    events = _stored_clean(spark, sf_dir)
    uniques = materialise(marts.uniques_mart(events), "uniques")
    exact = reports.kpi(events, *PERIOD).select(F.col("actors").alias("all_actors"), F.col("repos").alias("all_repos"))
    near = lambda c: F.abs(F.col(c) - F.col(f"all_{c}")) <= 3 * marts.SKETCH_DEVIATION * F.col(f"all_{c}")
    both = reports.kpi_sketch(uniques, *PERIOD).join(F.broadcast(exact))  # a row each
    return both.select(
        "events", "stars", "forks", "prs", "pushes", "events_per_day", near("actors").alias("actors_near"), near("repos").alias("repos_near")
    )


def rpt_repo_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the repository with the most events of the period."""
    events = clean(spark, sf_dir)
    name = reports.top_repos(events, *PERIOD, "events", 1).select("repo_name").scalar()
    return reports.repo_days(events, *PERIOD, name)


def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = {f"{end}_hour": F.date_trunc("hour", f"{end}_event") for end in ("first", "last")}
    return data_bounds(clean(spark, sf_dir)).withColumns(hours)


# --- snapshots and features --------------------------------------------------------------


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_calendar(data_bounds(clean(spark, sf_dir)), WINDOWS)


def event_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign_snapshots(clean(spark, sf_dir).select("event_id", "created_at"), WINDOWS)
    return placed.select("event_id", "snapshot_date", "observed", "label_available")


def repo_latest_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.repo_latest_attributes(clean(spark, sf_dir))


def top_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.top_actor(clean(spark, sf_dir), WINDOWS)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_label(features.repo_activity(clean(spark, sf_dir), WINDOWS))
    return features.labelled(rows).select("snapshot_date", "repo_id", "future_events", "abandoned")


def features_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.repo_activity(clean(spark, sf_dir), WINDOWS)
    return rows.drop("top_actor_events", "future_events", "label_available")


def features_from_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from panes that were stored without the events of a middle day and then brought up to date by a load of it."""
    lines = untidy_lines(read_clickstream(spark, sf_dir))
    database = f"codetide_{uuid.uuid4().hex}"
    late = F.col("file_name").startswith(LATE_DAY)
    ensure_database(spark, database)
    try:
        incremental.merge_arrivals(lines.where(~late), database, AS_OF, WINDOWS)
        incremental.merge_arrivals(lines.where(late), database, AS_OF, WINDOWS)
        rows = aggregates.stored_activity(spark, database, WINDOWS)
        return materialise(rows.drop("top_actor_events", "future_events", "label_available"), "from_panes")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def features_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_ratios(features.repo_activity(clean(spark, sf_dir), WINDOWS))
    return rows.select(
        "snapshot_date", "repo_id", "top_actor_share", "events_per_active_day", "commits_per_push",
        "trend_ratio", "events_per_actor",
    )


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.snapshot_rows(clean(spark, sf_dir), WINDOWS)


def dataset_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_dataset(clean(spark, sf_dir), WINDOWS)[0]


def dataset_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_dataset(clean(spark, sf_dir), WINDOWS)[1]


def abandoned_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.abandoned_repos(clean(spark, sf_dir), WINDOWS)


def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.dataset_summary(dataset_train(spark, sf_dir))


# --- preparation for models --------------------------------------------------------------


def lang_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(dataset_train(spark, sf_dir), "labelled")
    return split.with_language_bucket(rows, split.top_languages(rows)).select(
        "snapshot_date", "repo_id", "language", "lang_bucket"
    )


def lang_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(dataset_train(spark, sf_dir), "labelled")
    languages = [r.language for r in split.top_languages(rows).collect()]
    stages = Pipeline(stages=training.feature_stages(languages)[:2])
    encoded = stages.fit(training.prepared(rows)).transform(training.prepared(rows))
    one_hot = vector_to_array("language_vector")
    names = [*[f"lang_{place}" for place in range(len(languages))], "lang_other"]
    return encoded.select(
        "snapshot_date", "repo_id", *[one_hot[i].alias(name) for i, name in enumerate(names)]
    )


def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.with_validation(split.with_split(dataset_train(spark, sf_dir)))
    return rows.select("snapshot_date", "repo_id", "is_test", "is_validation")


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.class_weights(dataset_train(spark, sf_dir))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric columns as the logistic model sees them; the language columns are left empty here."""
    rows = training.prepared(materialise(dataset_train(spark, sf_dir), "labelled"))
    zeros = F.lit(0.0).alias("language_other")
    vector = VectorAssembler(inputCols=[*features.NUMERIC_FEATURES, "language_other"], outputCol=training.FEATURES)
    filled = rows.select("*", zeros)
    stages = [vector, *training.population_scaler([], rows.count())]
    scaled = Pipeline(stages=stages).fit(filled).transform(filled)
    values = vector_to_array("scaled")
    return scaled.select(
        "snapshot_date",
        "repo_id",
        *[F.round(values[i], 6).alias(c) for i, c in enumerate(features.NUMERIC_FEATURES)],
    )


#: Settings with which the optimum is met to more digits than are compared.
EXACT = {"tol": 1e-14}
PROBABILITY_DECIMALS = 3


def _fitted(spark: SparkSession, train: DataFrame, name: str) -> PipelineModel:
    exact = {name: EXACT} if name == "logreg_baseline" else {}
    return training.fit_models(materialise(train, "train"), {name: training.MODELS[name]}, **exact)[name]


def _trained(name: str) -> Query:
    """The test rows that a fitted model has scored, and whether the model's rows alone give the same probabilities."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test = training.training_rows(materialise(dataset_train(spark, sf_dir), "labelled"))
        model, key = _fitted(spark, train, name), ["snapshot_date", "repo_id"]
        scored = materialise(training.score(model, test).select(*key, "abandoned", "probability"), "scored")
        by_rows = model_tables.probability_by_rows(spark, model, test, *key).withColumnRenamed("probability", "by_rows")
        if name == "logreg_baseline":
            value = F.round("probability", PROBABILITY_DECIMALS).alias("probability")
        else:
            value = F.col("probability").between(0, 1).alias("scored")
        agree = F.abs(F.col("probability") - F.col("by_rows")) < 1e-9
        return scored.join(by_rows, key, "left").select(
            *key, "abandoned", F.lit(name).alias("model"), value, F.coalesce(agree, F.lit(False)).alias("rows_agree")
        )

    return query


# --- evaluation and predictions, on a formula as the model -------------------------------


def _recency() -> Column:
    return F.least(F.lit(1.0), F.col("hours_since_last") / 336.0)


def _slowdown() -> Column:
    return 1.0 / (1.0 + F.col("events_second_half"))


def _scored(spark: SparkSession, sf_dir: str, score=_recency) -> DataFrame:
    rows = dataset_train(spark, sf_dir).select(
        "snapshot_date", "repo_id", score().alias("probability"), F.col("abandoned").alias("label")
    )
    return materialise(rows, "scored")


def met_ranking(metric: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        curve = evaluation.score_curve(_scored(spark, sf_dir))
        return evaluation.ranking_metrics(curve).select(F.round(metric, METRIC_DECIMALS).alias(metric))

    return query


def met_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    return evaluation.top_k_metrics(scored, evaluation.score_curve(scored))


def met_best_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.best_f1(_scored(spark, sf_dir)).select("threshold", "f1")


def met_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion(_scored(spark, sf_dir), RECENCY_THRESHOLD)


def met_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.roc_curve(evaluation.score_curve(_scored(spark, sf_dir)))


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(dataset_train(spark, sf_dir), "labelled")
    results = []
    for name, score in (("recency", _recency), ("slowdown", _slowdown)):
        scored = rows.select(
            "snapshot_date", "repo_id", score().alias("probability"), F.col("abandoned").alias("label")
        )
        results.append(evaluation.evaluate(materialise(scored, name), name))
    history = evaluation.metrics_rows(results[0].unionByName(results[1]), rows, instant(LAST_RUN))
    rounded = [
        F.round(c, METRIC_DECIMALS).alias(c) if c in ("roc_auc", "pr_auc") else F.col(c)
        for c in history.columns
    ]
    return history.select(*rounded)


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.best_model(model_metrics(spark, sf_dir)).select("model", "pr_auc")


def latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of two runs, of which the earlier one was better."""
    last = materialise(model_metrics(spark, sf_dir), "run")
    earlier = last.withColumn("trained_at", instant(EARLIER_RUN)).withColumn("pr_auc", F.lit(1.0))
    return risk_reports.latest_metrics(materialise(earlier.unionByName(last), "metrics")).select(
        "trained_at", "model", "roc_auc", "pr_auc", "f1", "precision", "recall", "precision_at_k",
        "recall_at_k", "k",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = snapshot_rows(spark, sf_dir).withColumn("probability", _recency())
    return training.predictions(scored, "recency", RECENCY_THRESHOLD, LAST_RUN)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the earlier with half the risk and without labels."""
    last = predictions(spark, sf_dir)
    earlier = (
        last.withColumn("probability", F.col("probability") / 2)
        .withColumn("prediction", (F.col("probability") >= RECENCY_THRESHOLD).cast("int"))
        .withColumn("label", F.lit(None).cast("int"))
        .withColumn("trained_at", instant(EARLIER_RUN))
    )
    return materialise(earlier.unionByName(last), "predictions")


def predictions_backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the earlier run after the labels have become known."""
    stored = _history(spark, sf_dir).where(F.col("trained_at") == instant(EARLIER_RUN))
    rows = features.repo_activity(_stored_clean(spark, sf_dir), WINDOWS)
    return training.backfilled_labels(stored, rows)


def _over_history(report: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: report(_history(spark, sf_dir), *args)


def verdict_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = risk_reports.verdict_sample(_history(spark, sf_dir))
    return risk_reports.with_prediction(sample, 1)


def predictions_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train the baseline, score the open snapshots, write them by date and read them back."""
    train, predict = features.build_dataset(_stored_clean(spark, sf_dir), WINDOWS)
    rows, _ = training.training_rows(materialise(train, "labelled"))
    model = _fitted(spark, rows, "logreg_baseline")
    out = training.predictions(training.score(model, predict), "logreg_baseline", 0.5, LAST_RUN)
    path = scratch_path(spark, "export")
    out.write.partitionBy("snapshot_date").parquet(path)
    return spark.read.parquet(path).select(
        "snapshot_date", "repo_id", "repo_name", "language", "label", "model", "trained_at",
        F.round("probability", PROBABILITY_DECIMALS).alias("probability"), "prediction",
    )


SNAPSHOT = dt.date(2024, 1, 22)

QUERIES: dict[str, Query] = {
    "raw_scan": raw_scan,
    "raw_landing": raw_landing,
    "archive_quarantine": archive_quarantine,
    "incremental_etl": incremental_etl,
    "incremental_files": incremental_files,
    "landed_counts": landed_counts,
    "hour_manifest": hour_manifest,
    "hour_manifest_n": hour_manifest_n,
    "missing_hours": missing_hours,
    "backfill_progress": backfill_progress,
    "flt_target_types": flt_target_types,
    "flt_date_sanity": flt_date_sanity,
    "flt_bot_pushes": flt_bot_pushes,
    "flt_period": flt_period,
    "resolve_language": resolve_language,
    "dedup_events": dedup,
    "clean_events": clean,
    "mart_language": mart_language,
    "mart_repo": mart_repo,
    "mart_hourly": mart_hourly,
    "mart_merge": mart_merge,
    "data_bounds": bounds,
    "rpt_kpi": _over_events(reports.kpi),
    "rpt_kpi_sketch": rpt_kpi_sketch,
    "rpt_peak": _over_hourly(reports.peak_hour_of_a_type),
    "rpt_peak_total": _over_hourly(reports.peak_hour),
    "rpt_daily": _over_hourly(reports.daily_events),
    "rpt_mix": _over_hourly(reports.type_mix),
    "rpt_heatmap": _over_hourly(reports.weekday_hours),
    "rpt_heatmap_grid": _over_hourly(reports.weekday_hour_grid),
    "rpt_lang_stats": _over_events(reports.language_stats),
    "rpt_lang_trend": _over_events(reports.language_trend),
    "rpt_top_repos_stars": _over_events(reports.top_repos, "stars"),
    "rpt_top_repos_forks": _over_events(reports.top_repos, "forks"),
    "rpt_top_repos_pushes": _over_events(reports.top_repos, "pushes"),
    "rpt_top_repos_events": _over_events(reports.top_repos, "events"),
    "rpt_repo_detail": rpt_repo_detail,
    "snapshot_calendar": calendar,
    "event_snapshot": event_snapshot,
    "repo_latest_attrs": repo_latest_attrs,
    "top_actor": top_actor,
    "labels": labels,
    "features_window": features_window,
    "features_from_panes": features_from_panes,
    "features_derived": features_derived,
    "dataset_train": dataset_train,
    "dataset_predict": dataset_predict,
    "abandoned_repos": abandoned_repos,
    "dataset_summary": dataset_summary,
    "lang_bucket": lang_bucket,
    "lang_onehot": lang_onehot,
    "group_split": group_split,
    "class_weights": class_weights,
    "scaled_features": scaled_features,
    "model_logreg": _trained("logreg_baseline"),
    "model_rf": _trained("random_forest"),
    "model_gbt": _trained("boosted_trees"),
    "met_roc_auc": met_ranking("roc_auc"),
    "met_pr_auc": met_ranking("pr_auc"),
    "met_at_k": met_at_k,
    "met_best_f1": met_best_f1,
    "met_confusion": met_confusion,
    "met_roc_curve": met_roc_curve,
    "model_metrics": model_metrics,
    "best_model": best_model,
    "latest_metrics": latest_metrics,
    "predictions": predictions,
    "predictions_backfilled": predictions_backfilled,
    "predictions_export": predictions_export,
    "predictions_final": _over_history(risk_reports.current_predictions),
    "latest_snapshot": _over_history(risk_reports.latest_snapshot),
    "rpt_pred_summary": _over_history(risk_reports.summary),
    "rpt_threshold": _over_history(risk_reports.effective_threshold),
    "rpt_prob_hist": _over_history(risk_reports.probability_histogram),
    "rpt_verdict_sample": _over_history(risk_reports.verdict_sample),
    "verdict_filtered": verdict_filtered,
    "verdict_outcome": _over_history(risk_reports.verdict_outcome, SNAPSHOT),
    "rpt_top_risk": _over_history(risk_reports.top_risk),
    "rpt_agreement": _over_history(risk_reports.agreement, SNAPSHOT),
    "rpt_risk_by_language": _over_history(risk_reports.risk_by_language),
    "rpt_risk_change": _over_history(risk_reports.risk_change),
}
