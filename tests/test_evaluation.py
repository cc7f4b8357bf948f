"""Metrics against direct computations in plain Python, ties and empty cases included."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from codetide.operators import evaluation as ev

SCHEMA = "snapshot_date date, repo_id long, probability double, label int"
DAY = dt.date(2025, 1, 15)


def scored(spark, pairs):
    return spark.createDataFrame([(DAY, i, float(p), y) for i, (p, y) in enumerate(pairs)], SCHEMA)


def sample(kind, n=400, seed=5):
    rng = random.Random(seed)
    if kind == "distinct":
        return [(rng.random(), rng.randint(0, 1)) for _ in range(n)]
    if kind == "tied":
        return [(rng.choice([0.0, 0.1, 0.25, 0.5, 1.0]), rng.randint(0, 1)) for _ in range(n)]
    if kind == "crowded":  # a third of the rows share one score, the rest differ only late
        return [(0.9 if rng.random() < 0.34 else 1e-6 * rng.random(), int(rng.random() < 0.3)) for _ in range(n)]
    if kind == "no positives":
        return [(rng.random(), 0) for _ in range(n)]
    if kind == "no negatives":
        return [(rng.random(), 1) for _ in range(n)]
    return [(0.25, 1), (0.35, 0), (0.35, 1)]


KINDS = ("distinct", "tied", "crowded", "no positives", "no negatives", "three rows")


@pytest.fixture(params=["coalesced", "many ranges"])
def ranges(request, spark):
    """Once as adaptive execution merges small ranges, once with every range kept."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(request.param == "coalesced").lower())
    yield request.param
    spark.conf.set(key, "true")


def direct_ranking(pairs):
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    auc = None
    if pos and neg:
        auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    ap, recall = 0.0, 0.0
    for t in sorted({p for p, _ in pairs}, reverse=True):
        hit = sum(p >= t for p in pos)
        if pos:
            ap += (hit / len(pos) - recall) * hit / sum(p >= t for p, _ in pairs)
            recall = hit / len(pos)
    return auc, ap


@pytest.mark.parametrize("kind", KINDS)
def test_ranking_and_curve(spark, ranges, kind):
    pairs = sample(kind)
    df = scored(spark, pairs)
    curve = ev.score_curve(df)
    row = ev.ranking_metrics(curve).first()
    auc, ap = direct_ranking(pairs)
    assert row.roc_auc == (None if auc is None else pytest.approx(auc, abs=1e-12))
    assert row.pr_auc == pytest.approx(ap, abs=1e-12)

    points = [(r.threshold, r.tpr, r.fpr) for r in ev.roc_curve(curve, False).collect()]
    n_pos, n_neg = sum(y for _, y in pairs), sum(1 - y for _, y in pairs)
    assert len(points) == len({p for p, _ in pairs}) + 1
    for t, tpr, fpr in points:
        assert tpr == (sum(p >= t for p, y in pairs if y) / n_pos if n_pos else (0 if t == float("inf") else None))
        assert fpr == (
            sum(p >= t for p, y in pairs if not y) / n_neg if n_neg else (0 if t == float("inf") else None)
        )


def test_dropped_points_lie_on_the_line(spark, ranges):
    pairs = sample("distinct")
    curve = ev.score_curve(scored(spark, pairs))
    full = sorted((r.fpr, r.tpr) for r in ev.roc_curve(curve, False).collect())
    corners = sorted((r.fpr, r.tpr) for r in ev.roc_curve(curve).collect())
    assert len(corners) < len(full) and set(corners) <= set(full)

    def area(points):
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))

    assert area(corners) == pytest.approx(area(full)) == pytest.approx(direct_ranking(pairs)[0])


def test_roc_auc_agrees_with_the_built_in_evaluator(spark):
    df = scored(spark, sample("crowded")).withColumn("label", ev.F.col("label").cast("double"))
    built_in = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
    ours = ev.ranking_metrics(ev.score_curve(df)).first().roc_auc
    assert ours == pytest.approx(built_in.evaluate(df), abs=1e-12)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("fraction", [0.05, 0.5])
def test_top_k(spark, kind, fraction):
    pairs = sample(kind)

    def key(i):
        text = f"{i}:{DAY.isoformat()}"
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)

    order = sorted(range(len(pairs)), key=lambda i: (-pairs[i][0], key(i), i))
    k = min(max(10, int(len(pairs) * fraction)), len(pairs))
    hits, positives = sum(pairs[i][1] for i in order[:k]), sum(y for _, y in pairs)
    df = scored(spark, pairs)
    row = ev.top_k_metrics(df, ev.score_curve(df), fraction).first()
    assert (row.k, row.precision_at_k) == (k, hits / k)
    assert row.recall_at_k == (hits / positives if positives else None)


@pytest.mark.parametrize("kind", KINDS)
def test_best_f1(spark, kind):
    pairs = sample(kind)
    best_t, best_f = 0.5, -1.0
    for t in sorted({round(p * 1000) / 1000 for p, _ in pairs}):
        tp = sum(p >= t and y for p, y in pairs)
        fp, fn = sum(p >= t and not y for p, y in pairs), sum(p < t and y for p, y in pairs)
        f = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
        if f > best_f:
            best_t, best_f = t, f
    df = scored(spark, pairs)
    row = ev.best_f1(df).first()
    assert (row.threshold, row.f1) == (best_t, best_f)
    direct = ev.confusion(df, best_t).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (direct.tn, direct.fp, direct.fn, direct.tp)
    assert (row.precision, row.recall) == (direct.precision, direct.recall)


def test_no_rows(spark):
    df = scored(spark, [])
    curve = ev.score_curve(df)
    assert tuple(ev.ranking_metrics(curve).first()) == (None, 0.0)
    assert tuple(ev.top_k_metrics(df, curve).first()) == (0, None, None)
    row = ev.best_f1(df).first()
    assert (row.threshold, row.f1) == (0.5, -1.0)


def test_every_thousandth_is_counted_exactly(spark):
    """Scores on and right beside the steps, where multiplying by 1000 may round."""
    import math

    pairs = []
    for i in range(1001):
        for p in (i / 1000, math.nextafter(i / 1000, 0), math.nextafter(i / 1000, 1)):
            pairs.append((min(max(p, 0.0), 1.0), i % 2))
    found = {r.threshold: r.tp + r.fp for r in ev.threshold_counts(scored(spark, pairs)).collect()}
    assert len(found) == 1001
    assert all(n == sum(p >= t for p, _ in pairs) for t, n in found.items())


def test_evaluate_is_one_row(spark):
    rows = ev.evaluate(scored(spark, sample("distinct")), "m").collect()
    assert len(rows) == 1 and rows[0].model == "m" and sum(map(sum, rows[0].confusion)) == 400
