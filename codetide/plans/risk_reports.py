"""Reports over prediction and metrics tables. Predictions are read latest version first."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codetide.functions.hashing import unit_hash
from codetide.functions.numeric import half_even, share
from codetide.operators.evaluation import DEFAULT_THRESHOLD
from codetide.operators.latest import at_latest, latest_per_key

# Lengths of the report tables.
SAMPLE_ROWS = 500
RISK_ROWS = 20


def is_flagged() -> Column:
    return F.col("prediction") == 1


def current_predictions(predictions: DataFrame) -> DataFrame:
    """One row per snapshot and repository: that of the last training run."""
    return latest_per_key(
        predictions, ["snapshot_date", "repo_id"], F.desc("trained_at"), F.asc("model"), F.desc("probability")
    )


def latest_snapshot(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.max("snapshot_date").alias("snapshot_date"))


def of_snapshot(predictions: DataFrame, snapshot: dt.date | None = None) -> DataFrame:
    """Current predictions of one snapshot, by default the last.

    The snapshot is chosen before versions are, so only its partition is read and ranked.
    """
    if snapshot is None:
        chosen = at_latest(predictions, "snapshot_date")
    else:
        chosen = predictions.where(F.col("snapshot_date") == F.lit(snapshot))
    return current_predictions(chosen)


def summary(predictions: DataFrame, snapshot: dt.date | None = None) -> DataFrame:
    counts = of_snapshot(predictions, snapshot).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_flagged()).alias("flagged"),
        F.count_if(F.col("prediction") == 0).alias("healthy"),
        F.count_if(F.col("label").isNotNull()).alias("known_labels"),
    )
    flagged_share = share(F.col("flagged"), F.col("total"))
    return counts.withColumn("flagged_share", flagged_share).withColumn(
        "healthy_share", 1 - F.col("flagged_share")
    )


def effective_threshold(predictions: DataFrame, snapshot: dt.date | None = None) -> DataFrame:
    """Smallest probability among the flagged, 0.5 when none is."""
    lowest = F.min(F.when(is_flagged(), F.col("probability")))
    return of_snapshot(predictions, snapshot).agg(
        F.coalesce(lowest, F.lit(DEFAULT_THRESHOLD)).alias("threshold")
    )


def probability_histogram(predictions: DataFrame, snapshot: dt.date | None = None) -> DataFrame:
    """Repositories per probability rounded to 0.1, and whether the bucket counts as flagged."""
    threshold = effective_threshold(predictions, snapshot).scalar()
    return (
        of_snapshot(predictions, snapshot)
        .groupBy(half_even(F.col("probability"), 1).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("repos"))
        .withColumn("flagged", F.col("bucket") >= threshold)
        .orderBy("bucket")
    )


def forecast_text() -> Column:
    return F.when(is_flagged(), "abandoned").otherwise("active")


def fact_text() -> Column:
    label = F.col("label")
    return F.when(label.isNull(), "unknown").when(label == 1, "abandoned").otherwise("active")


def verdict_sample(
    predictions: DataFrame, snapshot: dt.date | None = None, n: int = SAMPLE_ROWS
) -> DataFrame:
    """A stable mixed sample of ``n`` verdicts: ordered by a hash of the repository times risk."""
    key = unit_hash(F.col("repo_id")) * F.col("probability")
    return (
        of_snapshot(predictions, snapshot)
        .select(
            "repo_id", "repo_name", "language", "probability", "prediction", "label",
            forecast_text().alias("forecast"), fact_text().alias("fact"),
        )
        .orderBy(key, "repo_id")
        .limit(n)
    )


def with_prediction(verdicts: DataFrame, prediction: int) -> DataFrame:
    return verdicts.where(F.col("prediction") == prediction)


def verdict_outcome(
    predictions: DataFrame, snapshot: dt.date | None = None, repo_name: str | None = None
) -> DataFrame:
    """Forecast, fact and whether they agree (hit, miss or unknown), of one or all repositories."""
    rows = of_snapshot(predictions, snapshot)
    if repo_name is not None:
        rows = rows.where(F.col("repo_name") == repo_name)
    agrees = (F.col("label") == 1) == is_flagged()
    outcome = F.when(F.col("label").isNull(), "unknown").when(agrees, "hit").otherwise("miss")
    return rows.select(
        "repo_id", "repo_name", "probability", forecast_text().alias("forecast"),
        fact_text().alias("fact"), outcome.alias("outcome"),
    )


def top_risk(predictions: DataFrame, snapshot: dt.date | None = None, n: int = RISK_ROWS) -> DataFrame:
    return (
        of_snapshot(predictions, snapshot)
        .orderBy(F.desc("probability"), "repo_id")
        .limit(n)
        .select("repo_id", "repo_name", "language", "probability")
    )


def agreement(predictions: DataFrame, snapshot: dt.date | None = None) -> DataFrame:
    abandoned = F.col("label") == 1
    return of_snapshot(predictions, snapshot).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_flagged()).alias("flagged"),
        F.count_if(abandoned).alias("actually_abandoned"),
        F.count_if(is_flagged() & abandoned).alias("hits"),
    )


def risk_by_language(predictions: DataFrame, snapshot: dt.date | None = None) -> DataFrame:
    return (
        of_snapshot(predictions, snapshot)
        .groupBy("language")
        .agg(F.count(F.lit(1)).alias("repos"), F.count_if(is_flagged()).alias("flagged"))
        .withColumn("flagged_share", share(F.col("flagged"), F.col("repos")))
    )


def risk_change(predictions: DataFrame) -> DataFrame:
    """Change of each repository's probability against its previous snapshot.

    One shuffle by repository serves the choice of the latest run and the comparison.
    """
    history = Window.partitionBy("repo_id").orderBy("snapshot_date")
    previous = F.lag("probability").over(history)
    return current_predictions(predictions.repartition("repo_id")).select(
        "repo_id",
        "snapshot_date",
        "probability",
        previous.alias("previous"),
        (F.col("probability") - previous).alias("change"),
    )


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Models of the last training run, best average precision first."""
    return at_latest(metrics, "trained_at").orderBy(F.desc("pr_auc"), "model")
