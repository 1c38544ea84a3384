"""Queries whose fits hold many times what a scan reads: over a table in one partition each of their fits gets small partitions."""

import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor

from tabml.operators import models as M
from tabml.plans import catalog

#: Rows of each table, the bytes a fit's task may hold, and the rows that fit in them (288 bytes at least a row, dealt evenly).
ROWS, FIT_BYTES, MOST = 600, 20_000, 75
#: Query -> the forests and k-means that it fits, in order.
FITS = {
    "job_cars_all": (RandomForestRegressor, RandomForestClassifier, KMeans),
    "job_cars_reg": (RandomForestRegressor,),
    "job_cars_reg_checked": (RandomForestRegressor,),
    "rf_regress_10": (RandomForestRegressor,),
    "job_cars_clf": (RandomForestClassifier,),
    "job_cars_clf_checked": (RandomForestClassifier,),
    "rf_classify_10": (RandomForestClassifier,),
    "rf_leaf_rows": (RandomForestRegressor,),
    "job_avocado_all": (KMeans,),
    "job_avocado_clu": (KMeans,),
    "job_avocado_clu_checked": (KMeans,),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    part = [(i, f"name {i}", f"Brand#{i % 4}", f"TYPE{i * 7 % 3}", i % 11, 900.0 + i % 37) for i in range(ROWS)]
    part = spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    line = [
        (i // 4, i % 50, i % 9, i % 4, float(i % 13), 100.0 + i * 31 % 500, i % 5 / 100, i % 7 / 100, "ANR"[i % 3], "FO"[i * 5 % 7 % 2], dt.datetime(1995 + i % 4, 3, 2))
        for i in range(ROWS)
    ]
    line = spark.createDataFrame(
        line,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp",
    )
    for name, df in (("part", part), ("lineitem", line)):
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _fits(spark, tables, name, monkeypatch):
    """(estimator's class, rows of the partitions it was given) of every forest and k-means that the query fits."""
    seen = []
    for cls in (RandomForestRegressor, RandomForestClassifier, KMeans):
        def fit(self, data, dataset_fit=cls._fit):
            seen.append((type(self), [len(p) for p in data.select(self.getFeaturesCol()).rdd.glom().collect()]))
            return dataset_fit(self, data)

        monkeypatch.setattr(cls, "_fit", fit)
    catalog.QUERIES[name](spark, tables).collect()
    monkeypatch.undo()
    return seen


@pytest.mark.parametrize("name", FITS)
def test_every_fit_of_a_query_holds_little_in_a_task(spark, tables, name, monkeypatch):
    catalog.load_all()
    whole = _fits(spark, tables, name, monkeypatch)
    assert [max(rows) == sum(rows) for _, rows in whole] == [True] * len(FITS[name])  # small enough: as it is
    monkeypatch.setattr(M, "FIT_BYTES", FIT_BYTES, raising=False)
    dealt = _fits(spark, tables, name, monkeypatch)
    assert [cls for cls, _ in dealt] == list(FITS[name])
    assert all(max(rows) <= MOST for _, rows in dealt)
    assert [sum(rows) for _, rows in dealt] == [sum(rows) for _, rows in whole]  # no row is lost or doubled


def test_every_fit_of_the_avocado_job_holds_little_in_a_task(spark, tables, monkeypatch):
    """Its logistic fit, too: by itself it holds 48 bytes a row or more, so 10,000 bytes are at most 208 rows."""
    catalog.load_all()
    seen = []

    def fit(self, data, dataset_fit=LogisticRegression._fit):
        seen.append([len(p) for p in data.select(self.getFeaturesCol(), self.getLabelCol()).rdd.glom().collect()])
        return dataset_fit(self, data)

    monkeypatch.setattr(LogisticRegression, "_fit", fit)
    catalog.QUERIES["job_avocado_all"](spark, tables).collect()
    monkeypatch.setattr(M, "FIT_BYTES", 10_000, raising=False)
    catalog.QUERIES["job_avocado_all"](spark, tables).collect()
    (whole,), (dealt,) = seen[: len(seen) // 2], seen[len(seen) // 2 :]
    assert max(whole) == sum(whole) and sum(dealt) == sum(whole) and max(dealt) <= 10_000 // 48
    assert max(dealt) - min(dealt) <= 1


def test_a_dealt_logistic_fit_is_the_same_fit(spark, monkeypatch):
    rows = [(float(i % 7), float(i * 3 % 11), float((i * 5 % 13) + (i % 7) > 8)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, label double").coalesce(1)
    estimator = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), M.logistic_regression()])
    whole = M.fit_on(estimator, df, persist=True).stages[-1]
    monkeypatch.setattr(M, "FIT_BYTES", 1_000)
    dealt = M.fit_on(estimator, df, persist=True).stages[-1]
    assert dealt.coefficients.toArray().tolist() == pytest.approx(whole.coefficients.toArray().tolist(), rel=1e-4)
    assert dealt.intercept == pytest.approx(whole.intercept, rel=1e-4) and dealt.numClasses == 2
