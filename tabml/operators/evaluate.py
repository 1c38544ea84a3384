"""One-pass evaluators for any (label, prediction) frame.

Each metric family is one aggregate over the data (partial aggregation on every partition, a single tiny
shuffle), instead of one job per metric as with repeated ``Evaluator.evaluate`` calls or ``filter(...).count()``.

* ``regression_metrics``      — n, MSE, RMSE, MAE, R², explained variance, MAPE (zero labels excluded, counted).
* ``confusion``               — (label, prediction, count) table: the one pass classification metrics need.
* ``classification_metrics`` / ``metrics_from_confusion``
                              — accuracy and label-frequency-weighted precision / recall / F1 (the same
                                definitions as Spark's multiclass evaluator).
* ``binary_metrics`` / ``binary_from_confusion``
                              — TP/TN/FP/FN and positive-class accuracy / precision / recall / F1, zero-guarded.
* ``roc_area`` / ``area_under_roc``
                              — exact AUC by prefix sums over ranges of scores (Spark's evaluator only where binned).
* ``silhouette``              — squared-Euclidean silhouette (Spark's clustering evaluator).
* ``wssse`` / ``cluster_profile``
                              — squared distances to given centres from per-cluster moments; per cluster: size,
                                SSE and column means in one grouped pass.
* ``banded_errors``           — mean absolute error, mean label and count per band.
* ``metric_rows`` / ``to_long`` — tidy (job, task, split, metric, value) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regression_metrics(df: DataFrame, label: str | Column, prediction: str | Column) -> DataFrame:
    """Metrics over the rows that have both a label and a prediction (``n``); the others are counted in ``excluded``."""
    usable = _c(label).isNotNull() & _c(prediction).isNotNull()
    y = F.when(usable, _c(label).cast("double"))
    p = F.when(usable, _c(prediction).cast("double"))
    base = df.select(y.alias("_y"), p.alias("_p"), (y - p).alias("_e"))
    agg = base.agg(
        F.count("_y").alias("n"),
        F.count_if(F.col("_y").isNull()).alias("excluded"),
        F.avg(F.col("_e") * F.col("_e")).alias("mse"),
        F.avg(F.abs("_e")).alias("mae"),
        F.var_pop("_y").alias("_var_y"),
        F.stddev_samp("_y").alias("label_std"),
        F.var_pop("_p").alias("_var_p"),
        F.avg("_y").alias("_mean_y"),
        F.avg("_p").alias("_mean_p"),
        F.avg(F.when(F.col("_y") != 0, F.abs(F.col("_e") / F.col("_y")))).alias("_ape"),
        F.count_if(F.col("_y").isNull() | (F.col("_y") == 0)).alias("mape_excluded"),
    )
    return agg.select(
        "n",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        # R^2 = 1 - SSE/SST with SST = n * var_pop(y): var_pop is merged with a numerically stable update,
        # so the centred sum of squares comes out of the same single pass.
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var_y"))).alias("r2"),
        (F.col("_var_p") + (F.col("_mean_p") - F.col("_mean_y")) ** 2).alias("explained_variance"),
        (F.col("_ape") * 100).alias("mape"),
        "mape_excluded",
        "excluded",
        "label_std",
        F.try_divide(F.sqrt("mse"), F.col("label_std")).alias("rmse_std_ratio"),
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("count")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and weighted precision / recall / F1 from one confusion pass (see ``metrics_from_confusion``)."""
    return metrics_from_confusion(confusion(df, label, prediction))


def metrics_from_confusion(conf: DataFrame) -> DataFrame:
    """Accuracy and weighted precision / recall / F1 from a (label, prediction, count) table.

    Per label: precision = tp / predicted (0 when nothing is predicted as it), recall = tp / actual,
    F1 = 2PR / (P + R) (0 when P + R = 0); weighted by the label's share of rows.  Everything here works on the
    (#classes²)-row confusion table; when built from data, its one aggregation exchange is reused."""
    actual = conf.groupBy("label").agg(
        F.sum("count").alias("actual"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)).alias("tp"),
    )
    predicted = conf.groupBy(F.col("prediction").alias("p_label")).agg(F.sum("count").alias("predicted"))
    per = actual.join(predicted, actual["label"] == predicted["p_label"], "left").select(
        "label",
        "actual",
        "tp",
        F.coalesce(F.col("predicted"), F.lit(0)).alias("predicted"),
    )
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("actual")
    per = per.select("actual", "tp", prec.alias("_p"), rec.alias("_r"))
    f1 = F.when((F.col("_p") + F.col("_r")) > 0, 2 * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r")))
    f1 = f1.otherwise(F.lit(0.0))
    n = F.sum("actual")
    return per.agg(
        n.cast("bigint").alias("n"),
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("actual") * F.col("_p")) / n).alias("weighted_precision"),
        (F.sum(F.col("actual") * F.col("_r")) / n).alias("weighted_recall"),
        (F.sum(F.col("actual") * f1) / n).alias("weighted_f1"),
    )


def _binary_from_counts(counts: DataFrame) -> DataFrame:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    out = counts.select(
        "tp",
        "tn",
        "fp",
        "fn",
        total.alias("total"),
        F.when(total > 0, (tp + tn) / total).otherwise(F.lit(0.0)).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
    )
    p_, r_ = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when(p_ + r_ > 0, 2 * p_ * r_ / (p_ + r_)).otherwise(F.lit(0.0)))


def binary_metrics(df: DataFrame, label: str, prediction: str, positive: float = 1.0) -> DataFrame:
    """TP/TN/FP/FN as one aggregate, then positive-class accuracy / precision / recall / F1 (zero-guarded)."""
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    counts = df.agg(
        F.count_if(p & y).alias("tp"),
        F.count_if(~p & ~y).alias("tn"),
        F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"),
    )
    return _binary_from_counts(counts)


def binary_from_confusion(conf: DataFrame, positive: float = 1.0) -> DataFrame:
    """Binary metrics from a (label, prediction, count) table (no extra pass over the data)."""
    y = F.col("label") == F.lit(positive)
    p = F.col("prediction") == F.lit(positive)
    c = F.col("count")
    counts = conf.agg(
        *[
            F.coalesce(F.sum(F.when(cond, c)), F.lit(0)).cast("bigint").alias(name)
            for name, cond in (("tp", p & y), ("tn", ~p & ~y), ("fp", p & ~y), ("fn", ~p & y))
        ]
    )
    return _binary_from_counts(counts)


def roc_area(df: DataFrame, label: str, score: str, ranges: int | None = None) -> DataFrame:
    """(n_pos, n_neg, auc): exact area under the ROC curve as a plan, ties counted one half (Mann-Whitney).

    Rows are counted by distinct score (a hot score is one row); sketched quantiles cut the scores into ranges, each range
    is summed in order by one task, and what lies below a range is a sum over the ranges.  One label only: 0 without
    positives, 1 without negatives; no rows: NULL.  NULL scores are left out."""
    n_ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select((F.col(label).cast("double") > 0.5).alias("_pos"), F.col(score).cast("double").alias("_s")).filter("_s IS NOT NULL")
    cuts = rows.agg(F.percentile_approx("_s", F.lit([i / n_ranges for i in range(1, n_ranges)] or [0.5]), 10_000)).first()[0] or []
    edges = sorted({c for c in cuts if c == c and abs(c) != float("inf")}) or [0.0]
    cut = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol="_s", outputCol="_range", handleInvalid="keep")
    by_score = rows.groupBy("_s").agg(F.count_if("_pos").alias("p"), F.count_if(~F.col("_pos")).alias("q"))
    placed = cut.transform(by_score).select(F.col("_range").cast("int").alias("_range"), "_s", "p", "q")  # NaN: a range after all
    before = Window.partitionBy("_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("q").over(before), F.lit(0))
    part = placed.select("_range", "p", "q", (F.col("p") * (below + F.col("q") / 2)).alias("won"))
    part = part.groupBy("_range").agg(F.sum("p").alias("p"), F.sum("q").alias("q"), F.sum("won").alias("won"))
    earlier = F.coalesce(F.sum("q").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    total = part.select("p", "q", (F.col("won") + F.col("p") * earlier).alias("won")).agg(F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"), F.sum("won").alias("won"))
    area = F.when(F.col("n_pos") == 0, 0.0).when(F.col("n_neg") == 0, 1.0).otherwise(F.col("won") / F.col("n_pos").cast("double") / F.col("n_neg"))
    return total.select(F.coalesce("n_pos", F.lit(0)).alias("n_pos"), F.coalesce("n_neg", F.lit(0)).alias("n_neg"), area.alias("auc"))


def area_under_roc(df: DataFrame, label: str, score: str, num_bins: int = 0) -> float:
    """Area under the ROC curve.  ``num_bins=0`` (default) is exact: ``roc_area``.  A positive ``num_bins`` is Spark's
    evaluator with the curve down-sampled to about that many points (its own default is 1000)."""
    if num_bins == 0:
        return roc_area(df, label, score).first()["auc"]
    ev = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=num_bins
    )
    return ev.evaluate(df.select(F.col(label).cast("double").alias(label), F.col(score).cast("double").alias(score)))


def silhouette(df: DataFrame, features: str, prediction: str) -> float:
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=prediction, distanceMeasure="squaredEuclidean")
    return ev.evaluate(df)


def _spread(df: DataFrame, features: str, prediction: str, numeric: Sequence[str] = ()) -> DataFrame:
    """Per cluster, in one grouped pass over the vectors as they are (sparse ones are not expanded per row): size,
    mean and variance of each dimension, mean of each listed column.  k rows."""
    moments = Summarizer.metrics("mean", "variance").summary(F.col(features))
    return df.groupBy(F.col(prediction).cast("int").alias("cluster")).agg(
        F.count("*").alias("size"), moments.alias("_m"), *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in numeric]
    )


def _sse(row, center: Sequence[float]) -> float:
    """Sum of squared distances to a centre from moments: (n - 1) * variance + n * (mean - centre)^2, summed over
    dimensions; both terms are non-negative, so nothing cancels."""
    mean, variance, n = row["_m"]["mean"].toArray(), row["_m"]["variance"].toArray(), row["size"]
    return float(((n - 1) * variance + n * (mean - np.asarray(center, float)) ** 2).sum())


def wssse(df: DataFrame, features: str, prediction: str, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Sum over rows of the squared distance to the row's own centre.  k rows of moments reach the driver; their size
    is the model's."""
    rows = _spread(df, features, prediction).collect()
    total = (sum(_sse(r, centers[r["cluster"]]) for r in rows), sum(r["size"] for r in rows))
    return df.sparkSession.createDataFrame([total], "wssse double, n bigint")


def cluster_profile(
    df: DataFrame,
    features: str,
    prediction: str,
    centers: Sequence[Sequence[float]],
    numeric: Sequence[str] = (),
) -> DataFrame:
    """Per cluster, in ONE grouped pass: size, within-cluster sum of squared distances to the centre, and the mean of
    each listed column.  Partial aggregation keeps the shuffle at (#partitions x k) rows however skewed the clusters."""
    rows = [
        (r["cluster"], r["size"], _sse(r, centers[r["cluster"]]), *[r[f"mean_{c}"] for c in numeric])
        for r in _spread(df, features, prediction, numeric).collect()
    ]
    schema = T.StructType(
        [T.StructField("cluster", T.IntegerType()), T.StructField("size", T.LongType()), T.StructField("sse", T.DoubleType())]
        + [T.StructField(f"mean_{c}", T.DoubleType()) for c in numeric]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def banded_errors(
    df: DataFrame, band_col: Column, label: str, prediction: str, band_name: str = "band"
) -> DataFrame:
    err = F.abs(F.col(label).cast("double") - F.col(prediction).cast("double"))
    return (
        df.groupBy(band_col.alias(band_name))
        .agg(
            F.avg(err).alias("avg_abs_error"),
            F.avg(F.col(label).cast("double")).alias("avg_actual"),
            F.count("*").alias("count"),
        )
    )


def metric_rows(spark: SparkSession, job: str, task: str, split: str, metrics: dict[str, float]) -> DataFrame:
    """Scalar metrics (already computed) as tidy rows (job, task, split, metric, value)."""
    rows = [(job, task, split, k, None if v is None else float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "job string, task string, split string, metric string, value double")


def to_long(df: DataFrame, job: str, task: str, split: str, columns: Sequence[str]) -> DataFrame:
    """One-row metric frame -> tidy long rows via ``unpivot`` (stays a Spark plan, no collect)."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "metric", "value")
    return long.select(
        F.lit(job).alias("job"), F.lit(task).alias("task"), F.lit(split).alias("split"), "metric", "value"
    )
