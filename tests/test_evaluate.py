import itertools

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tabml.operators import evaluate as K
from tabml.operators.features import assembler
from tabml.operators.models import kmeans
from tests.conftest import SF_SMALL


def test_binary_guards_no_predicted_positives(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    r = K.binary_metrics(df, "label", "prediction").first()
    assert (r.tp, r.tn, r.fp, r.fn) == (0, 1, 0, 1)
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.accuracy == 0.5


def test_binary_guards_no_actual_positives(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "label double, prediction double")
    r = K.binary_metrics(df, "label", "prediction").first()
    assert r.recall == 0.0 and r.precision == 0.0 and r.f1 == 0.0


def test_mape_excludes_and_counts_zero_labels(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 5.0)], "label double, prediction double")
    r = K.regression_metrics(df, "label", "prediction").first()
    assert r.mape_excluded == 1
    assert r.mape == pytest.approx((0.5 + 0.25) / 2 * 100)


def test_regression_metrics_match_spark_evaluator(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_totalprice").alias("label"), (F.col("o_custkey") * 150.0 + 140000.0).alias("prediction")
    )
    ours = K.regression_metrics(o, "label", "prediction").first()
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    for name, ours_v in [("rmse", ours.rmse), ("mse", ours.mse), ("mae", ours.mae), ("r2", ours.r2),
                         ("var", ours.explained_variance)]:
        assert ours_v == pytest.approx(ev.evaluate(o, {ev.metricName: name}), rel=1e-9)


def test_weighted_metrics_match_spark_evaluator(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = li.select(
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("label"),
        F.when(F.col("l_discount") < 0.03, 0.0).when(F.col("l_discount") < 0.07, 1.0).otherwise(3.0).alias("prediction"),
    )  # class 3.0 is predicted but never actual, class 2.0 never predicted
    ours = K.classification_metrics(df, "label", "prediction").first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, v in [("accuracy", ours.accuracy), ("f1", ours.weighted_f1),
                    ("weightedPrecision", ours.weighted_precision), ("weightedRecall", ours.weighted_recall)]:
        assert v == pytest.approx(ev.evaluate(df, {ev.metricName: name}), rel=1e-12)


def test_auc_matches_brute_force_pairs(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.when(F.col("event_type") == "click", 1.0).otherwise(0.0).alias("label"),
        F.round("value", 0).alias("score"),  # many ties
    )
    rows = ev.collect()  # small fixture, brute force only in the test
    pos = [r.score for r in rows if r.label == 1.0]
    neg = [r.score for r in rows if r.label == 0.0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    assert K.area_under_roc(ev, "label", "score") == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_silhouette_matches_brute_force(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(300).select(
        "l_quantity", (F.col("l_discount") * 100).alias("d"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("c"),
    )
    rows = li.collect()
    df = assembler(["l_quantity", "d"], "features").transform(spark.createDataFrame(rows))
    pts = [((r.l_quantity, r.d), r.c) for r in rows]

    def dist(a, b):
        return (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2

    scores = []
    for i, (x, c) in enumerate(pts):
        own = [dist(x, y) for j, (y, cy) in enumerate(pts) if cy == c and j != i]
        if not own:
            scores.append(0.0)
            continue
        a = sum(own) / len(own)
        b = min(
            sum(dist(x, y) for y, cy in pts if cy == o) / sum(1 for _, cy in pts if cy == o)
            for o in {cc for _, cc in pts} if o != c
        )
        scores.append(0.0 if a == b else (1 - a / b if a < b else b / a - 1))
    assert K.silhouette(df, "features", "c") == pytest.approx(sum(scores) / len(scores), abs=1e-9)


def test_wssse_equals_training_cost(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_quantity", "l_discount", "l_tax")
    model = Pipeline(stages=[assembler(li.columns), kmeans(k=3, seed=42, max_iter=50)]).fit(li)
    km = model.stages[-1]
    w = K.wssse(model.transform(li), "features", "prediction", [c.tolist() for c in km.clusterCenters()]).first()
    assert w.n == li.count()
    assert w.wssse == pytest.approx(km.summary.trainingCost, rel=1e-6)


def test_to_long_and_banded(spark):
    df = spark.createDataFrame([(10.0, 12.0, 20), (20.0, 10.0, 40)], "label double, prediction double, age int")
    rep = {r.band: r for r in K.banded_errors(df, F.when(F.col("age") < 30, "young").otherwise("old"),
                                               "label", "prediction").collect()}
    assert rep["young"].avg_abs_error == 2.0 and rep["old"]["count"] == 1
    long = K.to_long(K.regression_metrics(df, "label", "prediction"), "j", "t", "test", ["rmse", "mae"]).collect()
    assert {r.metric for r in long} == {"rmse", "mae"} and all(r.job == "j" for r in long)


def test_binned_auc_is_close_to_exact(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.when(F.col("event_type") == "click", 1.0).otherwise(0.0).alias("label"), F.col("value").alias("score")
    )
    exact = K.area_under_roc(ev, "label", "score")
    assert K.area_under_roc(ev, "label", "score", num_bins=100) == pytest.approx(exact, abs=0.02)
