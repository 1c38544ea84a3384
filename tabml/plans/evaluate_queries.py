"""Evaluator queries (K*) on deterministic (label, prediction) frames, so that SQL can match them exactly.

Frames:
* multiclass — lineitem: label = return flag (A/N/R -> 0/1/2), prediction = discount band.
* binary     — events: label = is a click, prediction = value > 250, score = value.
* regression — orders: label = total price, prediction = a fixed linear rule of the customer key.
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators import evaluate as K
from tabml.operators.features import assembler
from tabml.operators.split import hash_split
from tabml.plans.catalog import query
from tabml.plans.feature_queries import rank_sql
from tabml.plans.sqlgen import EDGE_70, hashed_sql, unit_sql
from tabml.session import scratch_dir
from tabml.sources import load_table, write_metrics


# --- frames ----------------------------------------------------------------------------------------------------------
def multiclass_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    label = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    pred = F.when(F.col("l_discount") < 0.03, 0.0).when(F.col("l_discount") < 0.07, 1.0).otherwise(2.0)
    return li.select(label.alias("label"), pred.alias("prediction"))


MULTICLASS_SQL = """
mc AS (SELECT CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END::DOUBLE AS label,
              CASE WHEN l_discount < 0.03 THEN 0.0 WHEN l_discount < 0.07 THEN 1.0 ELSE 2.0 END::DOUBLE AS prediction
       FROM lineitem)"""


def binary_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load_table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("event_type") == "click", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("value") > 250, 1.0).otherwise(0.0).alias("prediction"),
        F.col("value").alias("score"),
    )


BINARY_SQL = """
bf AS (SELECT CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
              CASE WHEN value > 250 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, value AS score FROM events)"""


def regression_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_totalprice").alias("label"), (F.col("o_custkey") * 150.0 + 140000.0).alias("prediction")
    )


REGRESSION_SQL = """
rf AS (SELECT o_totalprice AS label, o_custkey * 150.0 + 140000.0 AS prediction FROM orders)"""


def _weighted_sql(frame: str) -> str:
    return f"""
conf AS (SELECT label, prediction, count(*) AS c FROM {frame} GROUP BY label, prediction),
act AS (SELECT label, sum(c) AS actual, sum(CASE WHEN label = prediction THEN c ELSE 0 END) AS tp
        FROM conf GROUP BY label),
prd AS (SELECT prediction AS label, sum(c) AS predicted FROM conf GROUP BY prediction),
per AS (SELECT act.label, actual, tp, coalesce(predicted, 0) AS predicted FROM act LEFT JOIN prd USING (label)),
pr AS (SELECT actual, tp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p, tp / actual AS r FROM per),
f1 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM pr)"""


# --- K01 / K02 / K03 ----------------------------------------------------------------------------------------------
@query(
    "eval_accuracy",
    sql=f"""
WITH {MULTICLASS_SQL}
SELECT count(*) AS n, CAST(count_if(label = prediction) AS BIGINT) AS correct,
       round(count_if(label = prediction) / count(*), 10) AS accuracy FROM mc
""",
)
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy from the confusion table (one pass, no filter-count plus a second count)."""
    m = K.classification_metrics(multiclass_frame(spark, sf_dir), "label", "prediction")
    return m.select(
        "n", F.round(F.col("accuracy") * F.col("n")).cast("bigint").alias("correct"), F.round("accuracy", 10).alias("accuracy")
    )


@query(
    "eval_f1_weighted",
    sql=f"""
WITH {MULTICLASS_SQL}, {_weighted_sql('mc')}
SELECT CAST(sum(actual) AS BIGINT) AS n, round(sum(tp) / sum(actual), 10) AS accuracy,
       round(sum(actual * p) / sum(actual), 10) AS weighted_precision,
       round(sum(actual * r) / sum(actual), 10) AS weighted_recall,
       round(sum(actual * f) / sum(actual), 10) AS weighted_f1
FROM f1
""",
)
def eval_f1_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label-frequency-weighted precision / recall / F1 (the multiclass evaluator's ``f1``)."""
    m = K.classification_metrics(multiclass_frame(spark, sf_dir), "label", "prediction")
    return m.select(
        "n", *[F.round(c, 10).alias(c) for c in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")]
    )


@query(
    "eval_builtin_evaluators",
    sql=f"""
WITH {MULTICLASS_SQL}, {_weighted_sql('mc')}, {REGRESSION_SQL}
SELECT 'multiclass' AS evaluator, 'accuracy' AS metric, round(sum(tp) / sum(actual), 8) AS value FROM f1
UNION ALL SELECT 'multiclass', 'f1', round(sum(actual * f) / sum(actual), 8) FROM f1
UNION ALL SELECT 'regression', 'rmse', round(sqrt(avg((label - prediction) ^ 2)), 4) FROM rf
UNION ALL SELECT 'regression', 'r2', round(1 - avg((label - prediction) ^ 2) / var_pop(label), 8) FROM rf
UNION ALL SELECT 'regression', 'mae', round(avg(abs(label - prediction)), 4) FROM rf
""",
)
def eval_builtin_evaluators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own evaluators, metric chosen three ways (constructor, ``setMetricName``, param map at
    ``evaluate``), as a parity check of the one-pass evaluators.  Each call is a separate job."""
    mc = multiclass_frame(spark, sf_dir)
    mce = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    acc = mce.evaluate(mc)
    f1 = mce.evaluate(mc, {mce.metricName: "f1"})
    rf = regression_frame(spark, sf_dir)
    ree = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    rmse = ree.setMetricName("rmse").evaluate(rf)
    r2 = ree.setMetricName("r2").evaluate(rf)
    mae = ree.evaluate(rf, {ree.metricName: "mae"})
    rows = [
        ("multiclass", "accuracy", round(acc, 8)),
        ("multiclass", "f1", round(f1, 8)),
        ("regression", "rmse", round(rmse, 4)),
        ("regression", "r2", round(r2, 8)),
        ("regression", "mae", round(mae, 4)),
    ]
    return spark.createDataFrame(rows, "evaluator string, metric string, value double")


# --- K04 / K07 --------------------------------------------------------------------------------------------------------
@query(
    "eval_confusion_binary",
    sql=f"""
WITH {BINARY_SQL},
c AS (SELECT CAST(count_if(prediction = 1 AND label = 1) AS BIGINT) AS tp,
             CAST(count_if(prediction = 0 AND label = 0) AS BIGINT) AS tn,
             CAST(count_if(prediction = 1 AND label = 0) AS BIGINT) AS fp,
             CAST(count_if(prediction = 0 AND label = 1) AS BIGINT) AS fn FROM bf),
m AS (SELECT *, tp + tn + fp + fn AS total,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c)
SELECT tp, tn, fp, fn, total, round(CASE WHEN total > 0 THEN (tp + tn) / total ELSE 0.0 END, 10) AS accuracy,
       round(precision, 10) AS precision, round(recall, 10) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 10) AS f1
FROM m
""",
)
def eval_confusion_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TP/TN/FP/FN and positive-class metrics in one aggregate (instead of four filtered counts)."""
    m = K.binary_metrics(binary_frame(spark, sf_dir), "label", "prediction")
    return m.select(
        "tp", "tn", "fp", "fn", "total", *[F.round(c, 10).alias(c) for c in ("accuracy", "precision", "recall", "f1")]
    )


@query(
    "eval_auc",
    sql=f"""
WITH {BINARY_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mr FROM bf),
n AS (SELECT sum(label) AS n1, count(*) - sum(label) AS n0 FROM bf)
SELECT CAST(n1 AS BIGINT) AS n_pos, CAST(n0 AS BIGINT) AS n_neg,
       round((sum(CASE WHEN label = 1 THEN mr END) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 10) AS auc
FROM r, n GROUP BY n1, n0
""",
)
def eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact area under ROC with ties counted one half (= Mann-Whitney U / (n1·n0))."""
    bf = binary_frame(spark, sf_dir)
    auc = K.area_under_roc(bf, "label", "score")
    counts = bf.agg(
        F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if(F.col("label") == 0).alias("n_neg")
    )
    return counts.select("n_pos", "n_neg", F.lit(round(auc, 10)).alias("auc"))


# --- K05 / K06 / K10 / K12 / K17 ---------------------------------------------------------------------------------------
@query(
    "eval_regression",
    sql=f"""
WITH {REGRESSION_SQL}
SELECT count(*) AS n, round(avg((label - prediction) ^ 2), 2) AS mse, round(sqrt(avg((label - prediction) ^ 2)), 6) AS rmse,
       round(avg(abs(label - prediction)), 6) AS mae, round(1 - avg((label - prediction) ^ 2) / var_pop(label), 10) AS r2,
       round(var_pop(prediction) + (avg(prediction) - avg(label)) ^ 2, 2) AS explained_variance
FROM rf
""",
)
def eval_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = K.regression_metrics(regression_frame(spark, sf_dir), "label", "prediction")
    return m.select(
        "n",
        F.round("mse", 2).alias("mse"),
        F.round("rmse", 6).alias("rmse"),
        F.round("mae", 6).alias("mae"),
        F.round("r2", 10).alias("r2"),
        F.round("explained_variance", 2).alias("explained_variance"),
    )


@query(
    "eval_mape",
    sql="""
SELECT round(avg(CASE WHEN l_tax <> 0 THEN abs((l_tax - l_discount / 2) / l_tax) END) * 100, 8) AS mape,
       CAST(count_if(l_tax = 0) AS BIGINT) AS mape_excluded, count(*) AS n
FROM lineitem
""",
)
def eval_mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAPE × 100; zero labels are excluded from the mean and counted."""
    li = load_table(spark, sf_dir, "lineitem").select(
        F.col("l_tax").alias("label"), (F.col("l_discount") / 2).alias("prediction")
    )
    m = K.regression_metrics(li, "label", "prediction")
    return m.select(F.round("mape", 8).alias("mape"), "mape_excluded", "n")


@query(
    "eval_rmse_ratio",
    sql=f"""
WITH {REGRESSION_SQL}
SELECT round(sqrt(avg((label - prediction) ^ 2)), 6) AS rmse, round(stddev_samp(label), 6) AS std_label,
       round(sqrt(avg((label - prediction) ^ 2)) / stddev_samp(label), 10) AS rmse_std_ratio
FROM rf
""",
)
def eval_rmse_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE and the label's standard deviation from the same single pass, and their ratio."""
    m = K.regression_metrics(regression_frame(spark, sf_dir), "label", "prediction")
    return m.select(
        F.round("rmse", 6).alias("rmse"),
        F.round("label_std", 6).alias("std_label"),
        F.round("rmse_std_ratio", 10).alias("rmse_std_ratio"),
    )


@query(
    "eval_regression_nulls",
    sql="""
WITH rf AS (SELECT CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_totalprice END AS label,
                   CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey * 150.0 + 140000.0 END AS prediction FROM orders),
u AS (SELECT * FROM rf WHERE label IS NOT NULL AND prediction IS NOT NULL)
SELECT count(*) AS n, (SELECT count(*) FROM rf) - count(*) AS excluded, round(sqrt(avg((label - prediction) ^ 2)), 6) AS rmse,
       round(1 - avg((label - prediction) ^ 2) / var_pop(label), 10) AS r2,
       round(var_pop(prediction) + (avg(prediction) - avg(label)) ^ 2, 2) AS explained_variance
FROM u
""",
)
def eval_regression_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a label or without a prediction count in no metric; they are reported."""
    rf = load_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_totalprice")).alias("label"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") * 150.0 + 140000.0).alias("prediction"),
    )
    m = K.regression_metrics(rf, "label", "prediction")
    return m.select(
        "n", "excluded", F.round("rmse", 6).alias("rmse"), F.round("r2", 10).alias("r2"),
        F.round("explained_variance", 2).alias("explained_variance"),
    )


@query(
    "eval_metric_list",
    sql=f"""
WITH {REGRESSION_SQL}
SELECT 'rmse' AS metric, round(sqrt(avg((label - prediction) ^ 2)), 6) AS value FROM rf
UNION ALL SELECT 'mae', round(avg(abs(label - prediction)), 6) FROM rf
UNION ALL SELECT 'r2', round(1 - avg((label - prediction) ^ 2) / var_pop(label), 10) FROM rf
""",
)
def eval_metric_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several requested metrics from ONE pass, as (metric, value) rows."""
    m = K.regression_metrics(regression_frame(spark, sf_dir), "label", "prediction")
    long = m.select(
        F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"), F.round("r2", 10).alias("r2")
    ).unpivot([], ["rmse", "mae", "r2"], "metric", "value")
    return long


# --- K08: silhouette --------------------------------------------------------------------------------------------------
def _sil_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_quantity",
        (F.col("l_discount") * 100).alias("disc"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("cluster"),
    )
    return assembler(["l_quantity", "disc"], "features").transform(li)


def _silhouette_sql(k: int = 3) -> str:
    stats = ", ".join(
        f"count_if(cl = {c}) AS n{c}, sum(CASE WHEN cl = {c} THEN x1 END) AS a{c}, "
        f"sum(CASE WHEN cl = {c} THEN x2 END) AS b{c}, sum(CASE WHEN cl = {c} THEN nrm END) AS q{c}"
        for c in range(k)
    )
    dists = ", ".join(f"nrm + q{c} / n{c} - 2 * (x1 * a{c} + x2 * b{c}) / n{c} AS d{c}" for c in range(k))
    own = "CASE cl " + " ".join(f"WHEN {c} THEN d{c} * n{c} / (n{c} - 1)" for c in range(k)) + " END"
    own_n = "CASE cl " + " ".join(f"WHEN {c} THEN n{c}" for c in range(k)) + " END"
    other = "CASE cl " + " ".join(
        f"WHEN {c} THEN least({', '.join(f'd{o}' for o in range(k) if o != c)})" for c in range(k)
    ) + " END"
    return f"""
WITH p AS (SELECT l_quantity AS x1, l_discount * 100 AS x2,
                  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS cl,
                  l_quantity * l_quantity + (l_discount * 100) * (l_discount * 100) AS nrm FROM lineitem),
s AS (SELECT {stats} FROM p),
d AS (SELECT cl, {own_n} AS own_n, {dists} FROM p, s),
ab AS (SELECT own_n, {own} AS a, {other} AS b FROM d, s)
SELECT round(avg(CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END), 8)
       AS silhouette
FROM ab
"""


@query("eval_silhouette", sql=_silhouette_sql())
def eval_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared-Euclidean silhouette (Spark's clustering evaluator: per-cluster sums, one pass per stage)."""
    s = K.silhouette(_sil_frame(spark, sf_dir), "features", "cluster")
    return spark.range(1).select(F.lit(round(s, 8)).alias("silhouette"))


# --- K11 / K16 / K15 -----------------------------------------------------------------------------------------------------
@query(
    "prediction_crosstab",
    sql=f"WITH {MULTICLASS_SQL} SELECT label, prediction, count(*) AS count FROM mc GROUP BY label, prediction",
)
def prediction_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-vs-actual contingency table."""
    return K.confusion(multiclass_frame(spark, sf_dir), "label", "prediction")


@query(
    "class_balance",
    sql=f"""
WITH {rank_sql('orders', 'o_orderstatus', 'r')},
t AS (SELECT o_orderstatus FROM {hashed_sql('orders', [('o_orderkey', 'bigint')])} WHERE {unit_sql('_h')} >= {EDGE_70})
SELECT o_orderstatus, r.idx AS label, count(*) AS count FROM t JOIN r ON o_orderstatus = r.lvl
GROUP BY o_orderstatus, r.idx
""",
)
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class balance of the held-out part: (class, label index, count)."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    model = StringIndexer(inputCol="o_orderstatus", outputCol="label").fit(o)
    _, test = hash_split(o, ["o_orderkey"], (0.7, 0.3), seed=42)
    return model.transform(test).groupBy("o_orderstatus", "label").agg(F.count("*").alias("count"))


@query(
    "metrics_report",
    sql=f"""
WITH {REGRESSION_SQL}, {MULTICLASS_SQL}, {_weighted_sql('mc')}
SELECT 'eval_demo' AS job, 'regression' AS task, 'all' AS split, 'rmse' AS metric,
       round(sqrt(avg((label - prediction) ^ 2)), 6) AS value FROM rf
UNION ALL SELECT 'eval_demo', 'regression', 'all', 'r2', round(1 - avg((label - prediction) ^ 2) / var_pop(label), 10) FROM rf
UNION ALL SELECT 'eval_demo', 'classification', 'all', 'accuracy', round(sum(tp) / sum(actual), 10) FROM f1
UNION ALL SELECT 'eval_demo', 'classification', 'all', 'weighted_f1', round(sum(actual * f) / sum(actual), 10) FROM f1
""",
)
def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tidy metric rows (job, task, split, metric, value) written to the parquet metrics sink and read back."""
    reg = K.regression_metrics(regression_frame(spark, sf_dir), "label", "prediction").select(
        F.round("rmse", 6).alias("rmse"), F.round("r2", 10).alias("r2")
    )
    clf = K.classification_metrics(multiclass_frame(spark, sf_dir), "label", "prediction").select(
        F.round("accuracy", 10).alias("accuracy"), F.round("weighted_f1", 10).alias("weighted_f1")
    )
    rows = K.to_long(reg, "eval_demo", "regression", "all", ["rmse", "r2"]).unionByName(
        K.to_long(clf, "eval_demo", "classification", "all", ["accuracy", "weighted_f1"])
    )
    path = write_metrics(rows, scratch_dir(spark, "metrics"))
    return spark.read.parquet(path).select("job", "task", "split", "metric", "value")
