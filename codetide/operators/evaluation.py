"""Ranking and threshold metrics of scored rows.

Scored rows have ``probability`` (0 to 1), ``label`` (0 or 1) and, for top-K, the unique key
``snapshot_date, repo_id``. The ranking metrics are read off a curve: one row per distinct
score with the counts at and above it, computed once and stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codetide.functions.hashing import hash32
from codetide.functions.numeric import share
from codetide.session import materialise

TIE_RANGE_SIZE = 1 << 16
THRESHOLD_STEPS = 1000

# Size of the reported top list, and the threshold of an empty sample.
TOP_FRACTION = 0.05
TOP_MINIMUM = 10
DEFAULT_THRESHOLD = 0.5


def score_curve(scored: DataFrame) -> DataFrame:
    """Per distinct score: positives and negatives at it, and at or above it (``tp``, ``fp``).

    Rows are combined per score, then the scores are cut into ranges of about equal size,
    however they are distributed, and counted up inside each range; the totals of the ranges,
    of which there are as many as shuffle partitions, give each range its start. The cut
    depends on a sample, so it is stored before anything refers to it twice. ``next`` holds
    the counts at the next lower score.
    """
    positive, negative = F.col("label") == 1, F.col("label") == 0
    per_score = scored.groupBy("probability").agg(
        F.count_if(positive).alias("pos"), F.count_if(negative).alias("neg")
    )
    cut = per_score.repartitionByRange(F.desc("probability")).withColumn("part", F.spark_partition_id())
    ranges = materialise(cut, "score_ranges")

    order = Window.orderBy("part")
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("part")
        .agg(
            F.sum("pos").alias("pos_here"),
            F.sum("neg").alias("neg_here"),
            F.max_by(F.struct("pos", "neg"), "probability").alias("top"),
        )
        .select(
            "part",
            F.coalesce(F.sum("pos_here").over(above), F.lit(0)).alias("pos_above"),
            F.coalesce(F.sum("neg_here").over(above), F.lit(0)).alias("neg_above"),
            F.lead("top").over(order).alias("next_top"),
        )
    )
    inside = Window.partitionBy("part").orderBy(F.desc("probability"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per shuffle partition: safe to broadcast at any scale.
    curve = ranges.join(F.broadcast(starts), "part").select(
        "probability",
        "pos",
        "neg",
        (F.col("pos_above") + F.sum("pos").over(so_far)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(so_far)).alias("fp"),
        F.coalesce(F.lead(F.struct("pos", "neg")).over(inside), F.col("next_top")).alias("next"),
    )
    return materialise(curve, "score_curve")


def ranking_metrics(curve: DataFrame) -> DataFrame:
    """One row: ``roc_auc`` (null with one class only) and ``pr_auc`` (average precision).

    ROC-AUC is the share of (positive, negative) pairs ranked rightly, ties counted half; its
    pair counts are exact integers. Average precision is the sum of precision times the step
    in recall, 0 without positives.
    """
    margin = (F.col("neg") - 2 * F.col("fp")).cast("decimal(19,0)")
    wins = F.sum(F.col("pos").cast("decimal(18,0)") * margin)
    sums = curve.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        wins.alias("wins_shifted"),
        F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("precision_sum"),
    )
    pos, neg = F.col("positives"), F.col("negatives")
    # Negatives below a score are all negatives minus those at or above it, summed at once.
    double_wins = F.col("wins_shifted") + 2 * pos.cast("decimal(38,0)") * neg
    pairs = 2.0 * pos.cast("double") * neg.cast("double")
    return sums.select(
        F.when((pos > 0) & (neg > 0), double_wins.cast("double") / pairs).alias("roc_auc"),
        F.when(pos > 0, F.col("precision_sum") / pos).otherwise(F.lit(0.0)).alias("pr_auc"),
    )


def roc_curve(curve: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """Points (``fpr``, ``tpr``, ``threshold``) for descending thresholds, starting at (0, 0).

    With ``drop_intermediate`` a point is left out when the steps to it and from it are the
    same, as such a point lies on the line between its neighbours.
    """
    totals = curve.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("all"))
    if drop_intermediate:
        here, following = F.struct("pos", "neg"), F.col("next")
        first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
        curve = curve.where(first | following.isNull() | (here != following))
    points = curve.withColumn("all", totals.scalar()).select(
        (F.col("fp") / F.nullif(F.col("all.n"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("all.p"), F.lit(0))).alias("tpr"),
        F.col("probability").alias("threshold"),
    )
    origin = totals.select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return points.unionByName(origin)


def top_k_metrics(
    scored: DataFrame, curve: DataFrame, fraction: float = TOP_FRACTION, minimum: int = TOP_MINIMUM
) -> DataFrame:
    """One row: ``k``, ``precision_at_k``, ``recall_at_k`` of the K highest scores.

    K grows with the data, so nothing is sorted or limited to K rows. The score at which the
    K-th row falls comes from the curve. Equal scores at the edge are ordered by
    a hash of the key: the edge is narrowed to one of 65,536 hash ranges by counting, and
    only the rows of that range are ranked.
    """
    sizes = curve.agg(
        F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).alias("n"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
    ).withColumn(
        "k",
        F.least(
            F.greatest(F.floor(F.col("n") * F.lit(fraction)), F.lit(minimum)), F.col("n")
        ).cast("bigint"),
    )
    until = F.col("tp") + F.col("fp")
    before = until - F.col("pos") - F.col("neg")
    # One row: the score of the K-th row.
    edge = (
        curve.withColumn("k", sizes.select("k").scalar())
        .where((before < F.col("k")) & (until >= F.col("k")))
        .select(
            "probability",
            (F.col("k") - before).alias("wanted"),
            (F.col("tp") - F.col("pos")).alias("hits_above"),
        )
    )
    ties = (
        scored.join(F.broadcast(edge), "probability")
        .withColumn("tie_key", hash32(F.col("repo_id"), F.col("snapshot_date")))
        .withColumn("tie_range", F.floor(F.col("tie_key") / TIE_RANGE_SIZE).cast("int"))
    )
    # One row: the hash range of the K-th row.
    ascending = Window.orderBy("tie_range").rowsBetween(Window.unboundedPreceding, -1)
    last_range = (
        ties.groupBy("tie_range")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("label") == 1).alias("hits"),
            F.max("wanted").alias("wanted"),
            F.max("hits_above").alias("hits_above"),
        )
        .withColumn("rows_before", F.coalesce(F.sum("rows").over(ascending), F.lit(0)))
        .withColumn("hits_before", F.coalesce(F.sum("hits").over(ascending), F.lit(0)))
        .where("rows_before < wanted and rows_before + rows >= wanted")
        .selectExpr("tie_range", "wanted - rows_before AS left", "hits_above + hits_before AS sure_hits")
    )
    order = Window.partitionBy("tie_range").orderBy("tie_key", "snapshot_date", "repo_id")
    hits = (
        ties.drop("wanted", "hits_above")
        .join(F.broadcast(last_range), "tie_range")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= F.col("left"))
        .agg((F.max("sure_hits") + F.count_if(F.col("label") == 1)).alias("hits"))
    )
    return sizes.withColumn("hits", F.coalesce(hits.scalar(), F.lit(0))).select(
        "k",
        F.when(F.col("k") > 0, F.col("hits") / F.col("k")).alias("precision_at_k"),
        F.when(F.col("positives") > 0, F.col("hits") / F.col("positives")).alias("recall_at_k"),
    )


def threshold_counts(scored: DataFrame) -> DataFrame:
    """Confusion counts at every candidate threshold: the scores rounded to 3 decimals.

    Rows at or above a candidate are counted by their unrounded score. Every row is reduced
    to the largest step of 0.001 that it reaches, so at most 1,001 rows are left to add up.
    """
    score = F.col("probability")
    grid = float(THRESHOLD_STEPS)
    guess = F.floor(score * grid).cast("int")
    reached = (
        F.when(score < guess / grid, guess - 1)
        .when(score >= (guess + 1) / grid, guess + 1)
        .otherwise(guess)
    )
    rounded = F.rint(score * grid).cast("int")
    counted = scored.groupBy(reached.alias("reached"), rounded.alias("rounded")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    steps = counted.select(
        F.explode(
            F.array(
                F.struct(F.col("reached").alias("step"), "pos", "neg", F.lit(False).alias("candidate")),
                F.struct(
                    F.col("rounded").alias("step"),
                    F.lit(0).cast("bigint").alias("pos"),
                    F.lit(0).cast("bigint").alias("neg"),
                    F.lit(True).alias("candidate"),
                ),
            )
        ).alias("s")
    )
    per_step = steps.groupBy("s.step").agg(
        F.sum("s.pos").alias("pos"), F.sum("s.neg").alias("neg"), F.bool_or("s.candidate").alias("candidate")
    )
    # A single partition, of at most 1,001 rows.
    at_or_above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.desc("step")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    tp, fp = F.sum("pos").over(at_or_above), F.sum("neg").over(at_or_above)
    return (
        per_step.select(
            "candidate",
            (F.col("step") / grid).alias("threshold"),
            tp.alias("tp"),
            fp.alias("fp"),
            (F.sum("pos").over(everything) - tp).alias("fn"),
            (F.sum("neg").over(everything) - fp).alias("tn"),
        )
        .where("candidate")
        .drop("candidate")
    )


def best_f1(scored: DataFrame) -> DataFrame:
    """One row: the threshold with the largest F1 (the smallest of equals) and its counts."""
    f1 = share(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    rated = threshold_counts(scored).withColumn("f1", f1)
    best = rated.agg(
        F.max_by(
            F.struct("threshold", "f1", "tp", "fp", "fn", "tn"), F.struct("f1", -F.col("threshold"))
        ).alias("b")
    )
    none = F.lit(0).cast("bigint")
    tp, fp, fn, tn = (F.coalesce(F.col(f"b.{c}"), none) for c in ("tp", "fp", "fn", "tn"))
    return best.select(
        F.coalesce("b.threshold", F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.coalesce("b.f1", F.lit(-1.0)).alias("f1"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        tn.alias("tn"),
        fp.alias("fp"),
        fn.alias("fn"),
        tp.alias("tp"),
    )


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """One row: confusion counts, precision and recall of ``probability >= threshold``."""
    flagged, abandoned = F.col("probability") >= threshold, F.col("label") == 1
    counts = scored.agg(
        F.count_if(~flagged & ~abandoned).alias("tn"),
        F.count_if(flagged & ~abandoned).alias("fp"),
        F.count_if(~flagged & abandoned).alias("fn"),
        F.count_if(flagged & abandoned).alias("tp"),
    )
    tp = F.col("tp")
    return counts.withColumn("precision", share(tp, tp + F.col("fp"))).withColumn(
        "recall", share(tp, tp + F.col("fn"))
    )


def evaluate(scored: DataFrame, model: str) -> DataFrame:
    """All metrics of one model as one row. ``scored`` should be a stored table."""
    curve = score_curve(scored)
    ranking, top, best = ranking_metrics(curve), top_k_metrics(scored, curve), best_f1(scored)
    # Three frames of exactly one row each, put side by side.
    return (
        best.withColumn("ranking", ranking.select(F.struct("*")).scalar())
        .withColumn("top", top.select(F.struct("*")).scalar())
        .select(
            F.lit(model).alias("model"),
            "ranking.roc_auc",
            "ranking.pr_auc",
            "f1",
            "threshold",
            "precision",
            "recall",
            "top.precision_at_k",
            "top.recall_at_k",
            "top.k",
            F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion"),
        )
    )


def metrics_rows(evaluated: DataFrame, rows: DataFrame, trained_at: Column) -> DataFrame:
    """Evaluation rows in the layout of the metrics history.

    ``params`` holds what the history has no column for: threshold and confusion matrix.
    """
    summary = rows.agg(
        F.struct(
            F.count(F.lit(1)).alias("dataset_rows"), F.avg("abandoned").alias("abandoned_share")
        ).alias("s")
    )
    return evaluated.withColumn("s", summary.scalar()).select(
        trained_at.alias("trained_at"),
        "model",
        "s.dataset_rows",
        "s.abandoned_share",
        "roc_auc",
        "pr_auc",
        "f1",
        "precision",
        "recall",
        "precision_at_k",
        "recall_at_k",
        "k",
        F.to_json(F.struct("threshold", "confusion")).alias("params"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the largest average precision, ties by model name."""
    return metrics.orderBy(F.desc("pr_auc"), "model").limit(1)
