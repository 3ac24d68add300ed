import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate
from millrace.operators.anomaly import diagonal_distance, fit_diagonal, fit_gaussian, mahalanobis
from millrace.operators.model import as_column, register_sql, score_table, train
from millrace.operators.split import hash_split


def scores(spark, data):
    return spark.createDataFrame(data, "s double, y int")


def pairs_auroc(data):
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auroc_with_ties(spark):
    rnd = random.Random(1)
    data = [(round(rnd.random(), 1), int(rnd.random() < 0.4)) for _ in range(200)]
    df = scores(spark, data)
    want = pytest.approx(pairs_auroc(data))
    assert evaluate.auroc(df, "s", "y").first()["auroc"] == want
    assert evaluate.auroc(df.withColumn("s", F.exp("s") * 3 - 1), "s", "y").first()["auroc"] == want
    roc = evaluate.roc_curve(df, "s", "y").orderBy(F.desc("threshold")).collect()
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(roc, roc[1:], strict=False))
    area += roc[0]["fpr"] * roc[0]["tpr"] / 2
    assert area == want
    assert (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)


@pytest.mark.parametrize("data", [[], [(0.5, 1), (0.7, 1)], [(0.2, 0)]])
def test_one_class_or_none(spark, data):
    df = scores(spark, data)
    assert evaluate.auroc(df, "s", "y").first()["auroc"] is None
    assert evaluate.classifier_metrics(df.withColumn("p", F.lit(0)), "y", "p").count() == 1
    best = evaluate.best_f1_threshold(df, "s", "y").collect()
    assert len(best) == 1


def test_best_threshold_by_brute_force(spark):
    rnd = random.Random(2)
    data = [(round(rnd.random(), 2), int(rnd.random() < 0.3)) for _ in range(150)]

    def f1(t):
        tp = sum(1 for s, y in data if s >= t and y)
        fp = sum(1 for s, y in data if s >= t and not y)
        fn = sum(1 for s, y in data if s < t and y)
        return 2 * tp / (2 * tp + fp + fn)

    best = evaluate.best_f1_threshold(scores(spark, data), "s", "y").first()
    top = max(f1(t) for t, _ in data)
    assert best["f1"] == pytest.approx(top)
    assert best["threshold"] == min(t for t, _ in data if f1(t) == top)


def test_minmax(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (3.0,)], "s double")
    assert sorted(r["normalised"] for r in evaluate.minmax(df, "s").collect()) == [0.0, 0.5, 1.0]
    assert {r["normalised"] for r in evaluate.minmax(df, "s", (3.0, 3.5)).collect()} == {0.0, 1.0}
    assert [r["normalised"] for r in evaluate.minmax(df.filter("s = 2"), "s").collect()] == [0.0]


def gates(spark, **changes):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 0), ("b", 1, 0), ("b", 1, 1)], "g string, y int, p int")
    args = {"segments": ["g"], "description": "long enough to be of use", "artifacts": 1, "inputs": ["g"]} | changes
    out = evaluate.run_gates(df, "y", "p", **args).collect()
    return {r["gate"]: r["passed"] for r in out}


def test_gates(spark):
    assert gates(spark, min_segment_accuracy=0.5)["verdict"] is True
    low = gates(spark)
    assert low["demo_test"] is False and low["verdict"] is False
    assert gates(spark, segments=["g", "missing"], min_segment_accuracy=0.1)["demo_test"] is False
    assert gates(spark, description="short", min_segment_accuracy=0.1)["verdict"] is False
    assert gates(spark, artifacts=0, min_segment_accuracy=0.1)["has_artifacts"] is False
    assert gates(spark, inputs=["nope"], min_segment_accuracy=0.1)["has_signature"] is False


def test_permutation_importance(spark):
    df = spark.range(400).selectExpr("id", "cast(id % 2 as int) x", "cast(id % 5 as int) noise", "cast(id % 2 as int) y")
    out = evaluate.permutation_importance(df, "id", ["x", "noise"], "y", lambda v: v["x"] + v["noise"] * 0)
    got = {r["feature"]: r for r in out.collect()}
    assert got["noise"]["importance"] == 0.0
    assert 0.35 < got["x"]["importance"] < 0.65
    assert got["x"]["accuracy"] == 1.0


def test_log_loss_leaves_unknown_truth_out(spark):
    df = spark.createDataFrame([(1, 0.9), (None, 0.9), (0, None)], "y int, p double")
    assert evaluate.log_loss(df, "y", "p").first()["log_loss"] == pytest.approx(0.105360516)


def test_gaussian_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + 3
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    model = fit_gaussian(df.repartition(3), "v", 0.01)
    assert model.count == 300 and model.mean == pytest.approx(x.mean(axis=0))
    inv = np.linalg.inv(np.cov(x.T, bias=True) + 0.01 * np.eye(5))
    want = [float(np.sqrt((r - x.mean(0)) @ inv @ (r - x.mean(0)))) for r in x]
    got = df.select("id", mahalanobis(model, F.col("v")).alias("d")).orderBy("id").collect()
    assert [r["d"] for r in got] == pytest.approx(want)
    mean, var = fit_diagonal(df, "v")
    diag = df.select("id", diagonal_distance(F.col("v"), mean, var, 0.0).alias("d")).orderBy("id").collect()
    assert [r["d"] for r in diag] == pytest.approx(list(np.sqrt((((x - x.mean(0)) ** 2) / x.var(0)).sum(1))))


@pytest.mark.parametrize("kind", ["logistic", "gbt"])
def test_train(spark, kind):
    df = spark.range(300).selectExpr("id", "cast(id % 10 as double) x", "cast(id % 10 >= 5 as int) y")
    df = hash_split(df, ["id"], {"train": 0.6, "val": 0.2, "test": 0.2}, 1)
    grid = [{"maxIter": 1}, {"maxIter": 10}]
    best = train(df, ["x"], "y", "split", grid, kind)
    assert len(best.runs) == 2 and max(f for _, f in best.runs) > 0.9
    scored = best.transform(df.filter("split = 'test'"))
    assert evaluate.accuracy(scored, "y", "prediction").first()["accuracy"] > 0.9
    again = score_table(df.filter("split = 'test'"), as_column(best))
    left = {r["id"]: round(r["probability"], 9) for r in again.collect()}
    assert left == {r["id"]: round(r["probability"], 9) for r in scored.collect()}
    register_sql(spark, "churn_model", best)
    df.createOrReplaceTempView("millrace_model_rows")
    by_sql = spark.sql("SELECT id, churn_model(x) AS p FROM millrace_model_rows WHERE split = 'test'")
    assert {r["id"]: round(r["p"], 9) for r in by_sql.collect()} == left
