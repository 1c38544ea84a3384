import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from tabml.operators.fixed_point import kmeans_step, logistic_gradient
from tabml.operators.models import kmeans, logistic_regression


def _points(spark, n=300):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b) * 50, float(k)) for (a, b), k in zip(rng.normal(size=(n, 2)), rng.integers(0, 3, n))]
    df = spark.createDataFrame(rows, "a double, b double, label double").repartition(4)
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_kmeans_step_matches_numpy_and_is_zero_at_a_fixed_point(spark):
    df = _points(spark)
    model = kmeans(k=3, max_iter=50).fit(df)
    centers = [c.tolist() for c in model.clusterCenters()]
    at_rest = kmeans_step(model.transform(df), "features", "prediction", centers)
    assert at_rest["off_nearest"] == 0 and at_rest["center_shift"] < 1e-4
    rows = model.transform(df).select(vector_to_array("features").alias("x"), "prediction").collect()
    x, own = np.array([list(r.x) for r in rows]), [r.prediction for r in rows]
    assert at_rest["total_ss"] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    moved = [[c[0] + 0.3, c[1] - 5] for c in centers]
    step = kmeans_step(model.transform(df), "features", "prediction", moved)
    d = ((x[:, None] - np.array(moved)[None]) ** 2).sum(2)
    near = d.argmin(1)
    means = np.array([x[near == k].mean(0) for k in range(3)])
    shift = np.sqrt(((means - moved) ** 2).sum(1))
    gain = (np.bincount(near, minlength=3) * shift**2).sum() / d.min(1).sum()
    assert step["center_shift"] == pytest.approx(shift.max()) and step["step_gain"] == pytest.approx(gain)
    assert step["off_nearest"] == sum(d[i, own[i]] > d[i].min() * (1 + 1e-6) for i in range(len(x)))
    assert step["total_ss"] == pytest.approx(at_rest["total_ss"])


def test_kmeans_step_of_no_rows(spark):
    df = _points(spark)
    model = kmeans(k=2).fit(df)
    none = kmeans_step(model.transform(df.limit(0)), "features", "prediction", [c.tolist() for c in model.clusterCenters()])
    assert none == {"off_nearest": 0, "center_shift": 0.0, "step_gain": 0.0, "total_ss": 0.0}


@pytest.mark.parametrize("classes", [2, 3])
def test_logistic_gradient_matches_numpy(spark, classes):
    df = _points(spark).filter(f"label < {classes}")
    for max_iter in (1, 100):
        model = logistic_regression(max_iter=max_iter).fit(df)
        scored = model.transform(df)
        got = logistic_gradient(scored, "features", "label", "probability", model.numClasses)
        rows = scored.select(vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"), "label").collect()
        x, p = np.array([list(r.x) for r in rows]), np.array([list(r.p) for r in rows])
        y = np.eye(classes)[[int(r.label) for r in rows]]
        slopes = (p - y).T @ x / len(x) / x.std(0, ddof=1)
        level = (p - y).mean(0)
        assert got["gradient"] == pytest.approx(max(np.abs(slopes).max(), np.abs(level).max()), abs=1e-12)
        if max_iter == 100:
            assert got["gradient"] < 1e-5 and got["newton_step"] < 1e-3


def test_constant_features_and_no_rows(spark):
    df = spark.createDataFrame([(float(i % 7), 1.0, float(i % 3 == 0)) for i in range(90)], "a double, one double, label double")
    df = VectorAssembler(inputCols=["a", "one"], outputCol="features").transform(df)
    model = logistic_regression().fit(df)
    assert logistic_gradient(model.transform(df), "features", "label", "probability", 2)["gradient"] < 1e-5
    assert logistic_gradient(model.transform(df.limit(0)), "features", "label", "probability", 2) == {"gradient": 0.0, "newton_step": 0.0}
