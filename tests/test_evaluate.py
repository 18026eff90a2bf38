"""AUCs, bootstrap, profit and weights against brute force and Spark ML."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabqual.operators import evaluate as ev


def _pairwise_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def preds(spark):
    rnd = random.Random(7)
    rows = [(i, int(rnd.random() < 0.3), round(rnd.random(), 2)) for i in range(600)]  # many ties
    return rows, spark.createDataFrame(rows, "id int, label int, score double")


def test_roc_auc_equals_pairwise(preds):
    rows, df = preds
    got = ev.auc_metrics(df, buckets=4).first()
    assert got["roc_auc"] == pytest.approx(_pairwise_auc([(y, s) for _, y, s in rows]))
    assert (got["positives"], got["negatives"]) == (sum(y for _, y, _ in rows), sum(1 - y for _, y, _ in rows))


def test_roc_and_pr_match_spark_ml_evaluator(preds):
    _, df = preds
    d = df.withColumn("label", F.col("label").cast("double"))
    roc = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderROC").evaluate(d)
    pr = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderPR").evaluate(d)
    got = ev.auc_metrics(df).first()
    assert got["roc_auc"] == pytest.approx(roc)
    assert got["pr_auc"] == pytest.approx(pr)


def test_grouped_auc_and_one_class_group(spark):
    rows = [("g1", 1, 0.9), ("g1", 0, 0.1), ("g1", 1, 0.4), ("g1", 0, 0.4), ("g2", 1, 0.5), ("g2", 1, 0.7)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: r["roc_auc"] for r in ev.auc_metrics(df, group_cols=["g"]).collect()}
    assert got["g1"] == pytest.approx(_pairwise_auc([(y, s) for g, y, s in rows if g == "g1"]))
    assert got["g2"] is None


def test_bootstrap_is_deterministic_and_brackets_auc(preds):
    rows, df = preds
    a = ev.bootstrap_auc_ci(df, id_col="id", replicates=50, seed=3).first()
    b = ev.bootstrap_auc_ci(df, id_col="id", replicates=50, seed=3).first()
    assert a == b
    auc = _pairwise_auc([(y, s) for _, y, s in rows])
    assert a["auc_ci_low"] < auc < a["auc_ci_high"]
    assert a["replicates_used"] == 50


def test_bootstrap_weights_are_poisson_one(preds):
    _, df = preds
    w = ev.bootstrap_weights(df, "id", replicates=40, seed=1)
    stats = w.agg(F.sum("_w").alias("s")).first()
    n = 600 * 40
    assert abs(stats["s"] / n - 1.0) < 0.03   # mean weight ~ 1


def test_bootstrap_one_class_gives_zero_interval(spark):
    df = spark.createDataFrame([(i, 1, i / 10) for i in range(10)], "id int, label int, score double")
    r = ev.bootstrap_auc_ci(df, id_col="id", replicates=20).first()
    assert (r["auc_ci_low"], r["auc_ci_high"], r["replicates_used"]) == (0.0, 0.0, 0)


def test_confusion_profit(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2), (0, 0.7), (0, 0.1), (1, 0.5)], "label int, score double")
    r = ev.confusion_profit(df).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 1)
    assert r["expected_profit"] == 2 * 600 - 120 - 350


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(0,)] * 2, "label int")
    got = {r["label"]: r["weight"] for r in ev.class_weights(df).collect()}
    assert got == {1: 8 / (2 * 6), 0: 8 / (2 * 2)}


def test_model_score_mart_drops_null_models(spark):
    a = spark.createDataFrame([("lr", 0.6), ("rf", 0.8), (None, 0.1)], "model string, test_roc_auc double")
    b = spark.createDataFrame([("lr", 0.7)], "model string, test_roc_auc double")
    got = {r["model"]: r["avg_test_roc_auc"] for r in ev.model_score_mart(a, b).collect()}
    assert got == {"lr": pytest.approx(0.65), "rf": pytest.approx(0.8)}


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
def test_bucketed_bootstrap_equals_weighted_auc(spark, hot_share):
    rnd = random.Random(21)
    rows = [(i, int(rnd.random() < 0.4), 0.5 if rnd.random() < hot_share else round(rnd.random(), 3))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    a = {r["rep"]: (round(r["roc_auc"], 9), r["positives"]) for r in
         ev.auc_metrics(ev.bootstrap_weights(df, "id", 30), group_cols=["rep"], weight_col="_w").collect()}
    b = {r["rep"]: (round(r["roc_auc"], 9), r["positives"]) for r in
         ev.bootstrap_auc(df, replicates=30, buckets=12).collect()}
    assert a == b and len(a) == 30


def test_bucketed_bootstrap_plan_shuffles_rows_once(spark):
    from tabqual.sources.sinks import plan_text
    df = spark.createDataFrame([(i, i % 2, (i % 97) / 97.0) for i in range(3000)], "id long, label int, score double")
    out = ev.bootstrap_auc(df, replicates=20, buckets=6)
    plan = plan_text(out, "simple")
    below_generate = plan.split("Generate explode")[1]
    above_generate = plan.split("Generate explode")[0]
    assert below_generate.count("Exchange hashpartitioning") == 1      # the one row shuffle
    assert "hashpartitioning(rep" in above_generate                    # only the small per-bucket table
    assert above_generate.count("Exchange") == 1
