import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.operators import evaluate as E


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    won = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return won / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.3)
        p = 0.25 if i % 3 == 0 else round(min(1.0, rng.random() * 0.8 + 0.2 * y), 3)
        rows.append((y, p, "abc"[i % 3]))
    return spark.createDataFrame(rows, "PD int, p double, model string").repartition(4).cache()


@pytest.fixture(params=[10_000, 60])
def parts(request, monkeypatch):
    monkeypatch.setattr(E, "ROWS_PER_PART", request.param)


def auc(df, **k):
    return E.roc_auc(df, **k).first()["roc_auc"]


def test_auc_equals_brute_force(scores, parts):
    rows = [(r["PD"], r["p"]) for r in scores.collect()]
    assert auc(scores) == pytest.approx(brute_auc(rows), abs=1e-12)
    judge = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="PD", numBins=0)
    assert auc(scores) == pytest.approx(judge.evaluate(scores), abs=1e-9)


def test_auc_by_group(scores, parts):
    got = {r["model"]: r["roc_auc"] for r in E.roc_auc(scores, by=["model"]).collect()}
    for m in "abc":
        rows = [(r["PD"], r["p"]) for r in scores.filter(F.col("model") == m).collect()]
        assert got[m] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert got["a"] == 0.5


def test_auc_properties(scores, parts):
    a = auc(scores)
    assert auc(scores.withColumn("p", 1 - F.col("p"))) == pytest.approx(1 - a)
    assert auc(scores.withColumn("p", F.exp("p") * 10 - 3)) == pytest.approx(a)
    assert auc(scores.filter("PD = 1")) is None


def test_eight_scores(eight_scores, parts):
    assert auc(eight_scores) == 0.71875


def test_curve(eight_scores):
    got = {r["threshold"]: (r["fpr"], r["tpr"]) for r in E.roc_curve(eight_scores).collect()}
    assert got == {
        None: (0, 0), 0.9: (0, 0.25), 0.3: (0.25, 0.5), 0.1: (0.5, 0.75), 0.05: (0.75, 1), 0.02: (1, 1),
    }


def test_curve_area_is_auc(scores, parts):
    points = sorted((r["fpr"], r["tpr"]) for r in E.roc_curve(scores).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(auc(scores))


def test_curve_on_grid(scores, parts):
    points = [(r["fpr"], r["tpr"]) for r in E.roc_curve(scores).collect()]
    grid = E.roc_on_grid(scores, points=11).orderBy("fpr").collect()
    assert [r["fpr"] for r in grid] == pytest.approx([i / 10 for i in range(11)])
    for r in grid:
        assert r["tpr"] == max(t for f, t in points if f <= r["fpr"] + 1e-9)


def test_scores_are_merged_and_shuffled_once(scores, monkeypatch):
    monkeypatch.setattr(E, "ROWS_PER_PART", 60)
    plan = E.roc_curve(scores)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # Only one exchange carries scores to be merged; the totals of the parts need none.
    merges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "score" in x]
    assert len(merges) == 1


@pytest.mark.parametrize("part", [50_000, 7])
def test_nan_and_missing_scores_are_left_out(spark, part, monkeypatch):
    monkeypatch.setattr(E, "ROWS_PER_PART", part)
    rows = [(i % 2, (i * 37 % 101) / 101) for i in range(200)]
    clean = spark.createDataFrame(rows, "PD int, p double")
    dirty = spark.createDataFrame([*rows, (1, float("nan")), (0, float("nan")), (1, None), (None, 0.3)], "PD int, p double")
    assert E.roc_auc(dirty).first() == E.roc_auc(clean).first()
    assert E.roc_curve(dirty).count() == E.roc_curve(clean).count()


def test_scores_are_never_ranked_by_one_window(spark):
    scores = spark.range(2000).selectExpr("cast(id % 2 as int) as PD", "id / 2000 as p")
    plan = E.roc_curve(scores)._jdf.queryExecution().executedPlan().toString()
    # The only single partition is that of the totals of the parts.
    assert "Exchange hashpartitioning(part" in plan
    for line in plan.splitlines():
        assert "SinglePartition" not in line or "score" not in line


def test_threshold_is_chosen_before_rounding(spark):
    # Recall 0.9496 at 0.30 rounds to 0.950.
    counts = spark.createDataFrame([(0.05, 10_000, 50, 0), (0.30, 9_496, 20, 504)], "threshold double, tp bigint, fp bigint, fn bigint")
    chosen = E.choose_threshold(counts, 0.95).first()
    assert (chosen["threshold"], chosen["recall"]) == (0.05, 1.0)
    assert E.choose_threshold(counts, 0.9496).first()["threshold"] == 0.30
