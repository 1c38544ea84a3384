"""Estimators (Spark ML) with the parameters the analyses use, plus a fit helper for iterative training.

Iterative fits (logistic regression, forests, k-means) read their input many times; Spark ML caches the
compact training instances itself.  ``fit_on`` can additionally persist a prepared input (MEMORY_AND_DISK, so it
spills instead of failing) for the duration of a multi-stage fit and releases it afterwards; lost blocks are
recomputed from lineage.  Forests cache node ids (instead of shipping the growing trees to executors at every
level) and checkpoint that cache to the shared checkpoint directory every ``checkpointInterval`` iterations, so
deep forests keep a short lineage.

Forests, k-means and logistic regression hold every row as a dense array of its features, many times what a scan's task
read for it; ``dealt`` spreads the rows of a fit so that no task holds more than ``FIT_BYTES`` of them.
"""

from __future__ import annotations

from math import ceil

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.session import ensure_checkpoint_dir


def linear_regression(
    features: str = "features", label: str = "label", prediction: str = "prediction", max_iter: int = 100, **kw
) -> LinearRegression:
    """Ordinary least squares (``solver=auto`` picks the normal equations up to 4096 features: one pass)."""
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol=prediction, maxIter=max_iter, **kw)


def logistic_regression(
    features: str = "features",
    label: str = "label",
    prediction: str = "prediction",
    max_iter: int = 100,
    family: str = "auto",
    **kw,
) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features, labelCol=label, predictionCol=prediction, maxIter=max_iter, family=family, **kw
    )


def random_forest_regressor(
    features: str = "features", label: str = "label", num_trees: int = 10, seed: int = 42, **kw
) -> RandomForestRegressor:
    kw.setdefault("checkpointInterval", 10)
    kw.setdefault("cacheNodeIds", True)
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees, seed=seed, **kw)


def random_forest_classifier(
    features: str = "features", label: str = "label", num_trees: int = 10, seed: int = 42, **kw
) -> RandomForestClassifier:
    kw.setdefault("checkpointInterval", 10)
    kw.setdefault("cacheNodeIds", True)
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees, seed=seed, **kw)


def kmeans(
    features: str = "features", k: int = 3, seed: int = 42, max_iter: int = 20, prediction: str = "prediction", **kw
) -> KMeans:
    return KMeans(featuresCol=features, k=k, seed=seed, maxIter=max_iter, predictionCol=prediction, **kw)


_FORESTS = (RandomForestRegressor, RandomForestClassifier)


def _has_forest(estimator) -> bool:
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    return any(isinstance(st, _FORESTS) for st in stages)


#: Prepared rows (bytes) that a task of an iterative fit holds at most, and the bytes of a row beside its numbers.
FIT_BYTES, ROW_BYTES = 128 << 20, 288


def _width(df: DataFrame, features: str) -> int:
    """Slots of a vector column: by its metadata, else by a row."""
    known = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    row = None if known else df.select(features).filter(F.col(features).isNotNull()).first()
    return known or (row[0].size if row else 0)


def held_bytes(estimator, width: int) -> int:
    """Bytes a fit holds for a row: a forest a bin for each feature and counts and nodes for each tree, k-means its numbers,
    a logistic fit its numbers, label and weight in blocks of rows."""
    if isinstance(estimator, LogisticRegression):
        return 8 * width + 16
    return ROW_BYTES + (4 * width + 16 * estimator.getNumTrees() if isinstance(estimator, _FORESTS) else 8 * width)


def dealt(df: DataFrame, estimator) -> DataFrame:
    """The columns a fit reads, in partitions that it holds in at most ``FIT_BYTES`` each.

    ``df`` as it is where its partitions are small enough.  Else rows are dealt evenly, whatever they hold, and ordered
    by a hash of the row, so that a partition computed again has its rows in the same places."""
    size = held_bytes(estimator, _width(df, estimator.getFeaturesCol()))
    per = df.groupBy(F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    found = per.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()  # one row
    if (found["most"] or 0) * size <= FIT_BYTES:
        return df
    named = [estimator.getOrDefault(p) for p in ("featuresCol", "labelCol", "weightCol") if estimator.hasParam(p) and estimator.isDefined(p)]
    rows = df.select(*[c for c in dict.fromkeys(named) if c in df.columns])
    rows = rows.withColumn("_place", F.xxhash64(*rows.columns)).repartition(ceil(found["all"] * size / FIT_BYTES))
    return rows.sortWithinPartitions("_place").drop("_place")


def _fit(estimator, df: DataFrame):
    last = estimator.getStages()[-1] if isinstance(estimator, Pipeline) and estimator.getStages() else estimator
    if not isinstance(last, (*_FORESTS, KMeans, LogisticRegression)):
        return estimator.fit(df)
    if last is estimator:
        return estimator.fit(dealt(df, estimator))
    prepared = Pipeline(stages=estimator.getStages()[:-1]).fit(df)
    return PipelineModel(stages=[*prepared.stages, last.fit(dealt(prepared.transform(df), last))])


def fit_on(estimator, df: DataFrame, persist: bool = False):
    """Fit ``estimator`` on ``df``; with ``persist``, keep ``df`` persisted only while the fit runs.

    Spark's iterative estimators already cache their own compact training instances when the input is not
    persisted, so ``persist`` is for inputs read by several stages (e.g. indexers plus a forest).  Forests checkpoint
    their node ids and need the shared checkpoint folder; other fits need none.  Large partitions are dealt anew for a
    forest, k-means or logistic regression that is fitted by itself or ends a pipeline."""
    if _has_forest(estimator):
        ensure_checkpoint_dir(df.sparkSession)
    if not persist or df.storageLevel != StorageLevel.NONE:
        return _fit(estimator, df)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(estimator, df)
    finally:
        df.unpersist()


def fit_status(model) -> dict[str, float]:
    """Iterations of an iterative fit and whether it stopped by its tolerance (1) or by the iteration limit (0)."""
    m = model.stages[-1] if isinstance(model, PipelineModel) else model
    s = m.summary
    iterations = s.numIter if hasattr(s, "numIter") else s.totalIterations
    return {"iterations": float(iterations), "converged": float(iterations < m.getMaxIter())}
