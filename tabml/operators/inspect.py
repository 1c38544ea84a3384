"""Model tables: fitted parameters and training summaries as small DataFrames.

Only model parameters cross to the driver (their size is fixed by the model: k × dims centres, one coefficient
per feature), never table rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def last_stage(model):
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def cluster_centers(spark: SparkSession, model, feature_names: Sequence[str] | None = None) -> DataFrame:
    """(cluster, dim, feature, value) rows."""
    centers = last_stage(model).clusterCenters()
    rows = []
    for ci, c in enumerate(centers):
        for d, v in enumerate(c):
            name = feature_names[d] if feature_names is not None and d < len(feature_names) else f"f{d}"
            rows.append((ci, d, name, float(v)))
    return spark.createDataFrame(rows, "cluster int, dim int, feature string, value double")


def slot_names(transformed: DataFrame, features: str, size: int) -> list[str]:
    """One name per slot of a feature vector, from the column's ML attributes (``brand_encoded_X`` for a one-hot
    level); ``f0, f1, ...`` for slots without a name (a scaled vector keeps none)."""
    attrs = transformed.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    named = {a["idx"]: a["name"] for kind in attrs.values() for a in kind if "name" in a}
    return [named.get(i, f"f{i}") for i in range(size)]


def _names(feature_names: Sequence[str] | None, size: int) -> list[str]:
    names = [f"f{i}" for i in range(size)] if feature_names is None else list(feature_names)
    if len(names) != size:
        raise ValueError(f"{len(names)} names for {size} coefficients; a one-hot input has one slot per level (see slot_names)")
    return names


def coefficients(spark: SparkSession, model, feature_names: Sequence[str] | None = None) -> DataFrame:
    """(term, coefficient) rows for a linear model, one per vector slot, intercept last."""
    m = last_stage(model)
    coefs = m.coefficients.toArray().tolist()
    rows = [*zip(_names(feature_names, len(coefs)), map(float, coefs)), ("intercept", float(m.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double")


def class_coefficients(model, feature_names: Sequence[str] | None = None, classes: Sequence[str] | None = None) -> list[tuple[str, str, float]]:
    """(class, term, coefficient) of a logistic model, one per class and vector slot; size fixed by the model.

    ``classes`` are the label names in index order; a binary fit has one row of coefficients, for index 1."""
    m = last_stage(model)
    mat, icpt = m.coefficientMatrix.toArray(), m.interceptVector.toArray()
    names = _names(feature_names, mat.shape[1])
    index = range(mat.shape[0]) if mat.shape[0] > 1 else [1]
    label = [str(i) if classes is None else str(classes[i]) for i in index]
    return [(c, t, float(v)) for c, row, b in zip(label, mat, icpt) for t, v in [*zip(names, row), ("intercept", b)]]


def multinomial_coefficients(
    spark: SparkSession, model, feature_names: Sequence[str] | None = None, classes: Sequence[str] | None = None
) -> DataFrame:
    """``class_coefficients`` as a DataFrame."""
    return spark.createDataFrame(class_coefficients(model, feature_names, classes), "class string, term string, coefficient double")


def regression_summary(model) -> dict[str, float]:
    """Training-set metrics recorded by the fit (no extra pass)."""
    s = last_stage(model).summary
    return {
        "r2": s.r2,
        "rmse": s.rootMeanSquaredError,
        "mae": s.meanAbsoluteError,
        "mse": s.meanSquaredError,
        "n": float(s.numInstances),
    }


def classification_summary(model) -> dict[str, float]:
    s = last_stage(model).summary
    return {
        "accuracy": s.accuracy,
        "weighted_precision": s.weightedPrecision,
        "weighted_recall": s.weightedRecall,
        "weighted_f1": s.weightedFMeasure(),
        "iterations": float(s.totalIterations),
    }


def kmeans_summary(model) -> dict[str, float]:
    s = last_stage(model).summary
    return {"training_cost": s.trainingCost, "iterations": float(s.numIter), "k": float(s.k)}
