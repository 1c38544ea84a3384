"""Estimator and model-inspection queries (J*, I*), with closed-form / score-equation / planted oracles."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.evaluate import regression_metrics
from tabml.operators.features import assembler
from tabml.operators.models import fit_on, linear_regression
from tabml.operators.split import hash_split
from tabml.plans.catalog import query
from tabml.plans.sqlgen import EDGE_70, hashed_sql, ols_ctes, ols_gauss_ctes, ols_prediction, unit_sql
from tabml.sources import load_table


def orders_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with calendar features of the order date (month, day of week 1 = Sunday)."""
    o = load_table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.month("o_orderdate").alias("month"),
        F.dayofweek("o_orderdate").alias("day_of_week"),
        "o_totalprice",
    )


_ORDERS_TIME_SQL = f"""
base AS (
  SELECT o_orderkey, month(o_orderdate) AS month, dayofweek(o_orderdate) + 1 AS day_of_week, o_totalprice,
         {unit_sql('_h')} AS u
  FROM {hashed_sql('orders', [('o_orderkey', 'bigint')])}),
train AS (SELECT * FROM base WHERE u < {EDGE_70}),
test AS (SELECT * FROM base WHERE u >= {EDGE_70})"""


# --- J09 / I05 / K05 / K06: the minimum slice -------------------------------------------------------------
@query(
    "ols_holdout_metrics",
    kind="C",
    sql=f"""
WITH {_ORDERS_TIME_SQL},
{ols_ctes('train', ['month', 'day_of_week'], 'o_totalprice')},
pred AS (SELECT o_totalprice AS y, {ols_prediction(['month', 'day_of_week'])} AS p FROM test, ols_b)
SELECT count(*) AS n,
       round(sqrt(avg((y - p) * (y - p))), 3) AS rmse,
       round(1 - avg((y - p) * (y - p)) / var_pop(y), 8) AS r2,
       round(avg(abs(y - p)), 3) AS mae,
       round(avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100, 5) AS mape
FROM pred
""",
)
def ols_holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders: month and weekday of the order date -> total price.  Hash split 70/30 on the order key, OLS fit
    on the train part, single-pass RMSE / R² / MAE / MAPE on the held-out part."""
    base = orders_time(spark, sf_dir)
    train, test = hash_split(base, ["o_orderkey"], (0.7, 0.3), seed=42)
    pipe = Pipeline(stages=[assembler(["month", "day_of_week"]), linear_regression(label="o_totalprice")])
    model = fit_on(pipe, train)
    m = regression_metrics(model.transform(test), "o_totalprice", "prediction")
    return m.select(
        "n",
        F.round("rmse", 3).alias("rmse"),
        F.round("r2", 8).alias("r2"),
        F.round("mae", 3).alias("mae"),
        F.round("mape", 5).alias("mape"),
    )


# --- J04 / I03: one-feature OLS with a custom prediction column ---------------------------------------------------
@query(
    "ols_single_coefficients",
    kind="C",
    sql="""
SELECT regr_count(l_extendedprice, l_quantity)::BIGINT AS n,
       round(regr_slope(l_extendedprice, l_quantity), 8) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 12) AS r2
FROM lineitem
""",
)
def ols_single_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: quantity -> extended price, ``maxIter=10`` and a custom prediction column; slope, intercept
    and the training R² from the model summary."""
    li = load_table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    lr = linear_regression(features="f", label="l_extendedprice", prediction="predicted_price", max_iter=10)
    model = fit_on(Pipeline(stages=[assembler(["l_quantity"], "f"), lr]), li)
    m = model.stages[-1]
    row = (int(m.summary.numInstances), round(float(m.coefficients[0]), 8), round(float(m.intercept), 6),
           round(float(m.summary.r2), 12))
    return spark.createDataFrame([row], "n bigint, slope double, intercept double, r2 double")


_MULTI_X = ["l_quantity", "l_discount", "l_tax"]


@query(
    "ols_multi_coefficients",
    kind="C",
    sql=f"""
WITH {ols_ctes('lineitem', _MULTI_X, 'l_extendedprice')}
SELECT 'l_quantity' AS term, round(b_1, 6) AS coefficient FROM ols_b
UNION ALL SELECT 'l_discount', round(b_2, 4) FROM ols_b
UNION ALL SELECT 'l_tax', round(b_3, 4) FROM ols_b
UNION ALL SELECT 'intercept', round(b_0, 4) FROM ols_b
""",
)
def ols_multi_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-feature OLS (default parameters): (term, coefficient) table with the intercept."""
    from tabml.operators.inspect import coefficients

    li = load_table(spark, sf_dir, "lineitem").select(*_MULTI_X, "l_extendedprice")
    model = fit_on(Pipeline(stages=[assembler(_MULTI_X), linear_regression(label="l_extendedprice")]), li)
    digits = {"l_quantity": 6, "l_discount": 4, "l_tax": 4, "intercept": 4}
    rows = [(t, round(v, digits[t])) for t, v in coefficients(spark, model, _MULTI_X).collect()]
    return spark.createDataFrame(rows, "term string, coefficient double")


def _onehot_sql() -> str:
    from tabml.plans.feature_queries import one_hot_sql, rank_sql

    feats = ["x1", "d0", "d1", "d2", "d3"]
    terms = "".join(
        f"\nUNION ALL SELECT 'c_mktsegment_encoded_' || lvl, round(b_{j + 2}, 4) FROM ols_b, r WHERE r.idx = {j}" for j in range(4)
    )
    return (
        f"WITH {rank_sql('customer', 'c_mktsegment', 'r')},\n"
        f"t AS (SELECT CAST(c_nationkey AS DOUBLE) AS x1, c_acctbal AS y, {one_hot_sql('r.idx', 4, 'd')} FROM customer JOIN r ON c_mktsegment = r.lvl),\n"
        f"{ols_gauss_ctes('t', feats, 'y')}\n"
        f"SELECT 'c_nationkey' AS term, round(b_1, 4) AS coefficient FROM ols_b{terms}\n"
        "UNION ALL SELECT 'intercept', round(b_0, 4) FROM ols_b"
    )


@query("ols_onehot_coefficients", kind="C", sql=_onehot_sql())
def ols_onehot_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of a model with a one-hot input: one row per vector slot, named by level."""
    from tabml.operators.features import FeatureSpec, fit_features
    from tabml.operators.inspect import coefficients, slot_names

    c = load_table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", "c_acctbal")
    x = fit_features(FeatureSpec(numeric=["c_nationkey"], one_hot=["c_mktsegment"]), c).transform(c)
    model = fit_on(linear_regression(label="c_acctbal"), x)
    table = coefficients(spark, model, slot_names(x, "features", model.numFeatures))
    return table.select("term", F.round("coefficient", 4).alias("coefficient"))


@query(
    "ols_train_summary",
    kind="C",
    sql=f"""
WITH {_ORDERS_TIME_SQL},
{ols_ctes('train', ['month', 'day_of_week'], 'o_totalprice')},
pred AS (SELECT o_totalprice AS y, {ols_prediction(['month', 'day_of_week'])} AS p FROM train, ols_b)
SELECT count(*) AS n, round(1 - avg((y - p) ^ 2) / var_pop(y), 10) AS r2, round(sqrt(avg((y - p) ^ 2)), 4) AS rmse,
       round(avg(abs(y - p)), 4) AS mae
FROM pred
""",
)
def ols_train_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-set R², RMSE, MAE recorded by the fit (the model summary: no extra scoring pass)."""
    from tabml.operators.inspect import regression_summary

    train, _ = hash_split(orders_time(spark, sf_dir), ["o_orderkey"], (0.7, 0.3), seed=42)
    model = fit_on(Pipeline(stages=[assembler(["month", "day_of_week"]), linear_regression(label="o_totalprice")]), train)
    s = regression_summary(model)
    row = (int(s["n"]), round(s["r2"], 10), round(s["rmse"], 4), round(s["mae"], 4))
    return spark.createDataFrame([row], "n bigint, r2 double, rmse double, mae double")


@query(
    "ols_score_rows",
    kind="C",
    sql="""
SELECT l_orderkey, l_linenumber, round(3 * l_quantity + 200 * l_discount - 50 * l_tax + 7, 6) AS prediction
FROM lineitem WHERE l_returnflag = 'R'
""",
)
def ols_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scoring: a model fitted on rows with return flag A/N scores the R rows.  The label is an exact
    linear rule of the features, so the least-squares fit recovers it and each scored value is known."""
    li = load_table(spark, sf_dir, "lineitem").withColumn(
        "y", 3 * F.col("l_quantity") + 200 * F.col("l_discount") - 50 * F.col("l_tax") + 7
    )
    fit_rows = li.filter(F.col("l_returnflag") != "R")
    score_rows = li.filter(F.col("l_returnflag") == "R")
    model = fit_on(Pipeline(stages=[assembler(_MULTI_X), linear_regression(label="y")]), fit_rows)
    return model.transform(score_rows).select("l_orderkey", "l_linenumber", F.round("prediction", 6).alias("prediction"))


# --- J01 / J02 / J12 / I04: logistic regression ------------------------------------------------------------------
def _doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels (inner equi-join on doc_id; only the needed columns are read)."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = load_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double").alias("toxic"))
    return docs.join(labels, "doc_id")


_DOC_LABELS_SQL = "dl AS (SELECT doc_id, lang, n_chars, toxic FROM documents JOIN labels USING (doc_id))"


@query(
    "logit_binary_rates",
    kind="C",
    sql=f"WITH {_DOC_LABELS_SQL} SELECT lang, count(*) AS n, round(avg(toxic), 5) AS rate FROM dl GROUP BY lang",
)
def logit_binary_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary logistic regression on one one-hot factor: at the optimum each level's predicted probability is
    the level's positive rate.  Probability column -> array (J12)."""
    from pyspark.ml.functions import vector_to_array

    from tabml.operators.features import FeatureSpec, feature_stages
    from tabml.operators.models import logistic_regression

    dl = _doc_labels(spark, sf_dir)
    spec = FeatureSpec(one_hot=["lang"])
    lr = logistic_regression(label="toxic", tol=1e-10)
    model = fit_on(Pipeline(stages=feature_stages(spec) + [lr]), dl)
    p1 = vector_to_array("probability")[1]
    return model.transform(dl).groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(p1), 5).alias("rate"))


def _orders_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _multi_fit(spark: SparkSession, sf_dir: str):
    from pyspark.ml.feature import StringIndexer

    from tabml.operators.features import FeatureSpec, feature_stages
    from tabml.operators.models import logistic_regression

    o = _orders_status(spark, sf_dir)
    spec = FeatureSpec(one_hot=["o_orderpriority"])
    stages = [StringIndexer(inputCol="o_orderstatus", outputCol="label")] + feature_stages(spec)
    lr = logistic_regression(family="multinomial", tol=1e-8, max_iter=200)
    return o, fit_on(Pipeline(stages=stages + [lr]), o)


@query(
    "logit_multi_rates",
    kind="C",
    sql="""
SELECT o_orderpriority, o_orderstatus AS class,
       round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 5) AS rate
FROM orders GROUP BY o_orderpriority, o_orderstatus
""",
)
def logit_multi_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multinomial logistic regression, 3 classes, one one-hot factor: predicted class probabilities per
    level equal the class shares per level.  Class indices are mapped back to names (Q15)."""
    from pyspark.ml.functions import vector_to_array

    o, model = _multi_fit(spark, sf_dir)
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])  # bounded: one entry per class
    scored = model.transform(o).select("o_orderpriority", F.posexplode(vector_to_array("probability")).alias("k", "p"))
    return scored.groupBy("o_orderpriority", names[F.col("k")].alias("class")).agg(F.round(F.avg("p"), 5).alias("rate"))


@query(
    "logit_train_accuracy",
    kind="C",
    sql="""
WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2),
m AS (SELECT o_orderpriority, max(n) AS top, sum(n) AS tot FROM c GROUP BY 1)
SELECT round(sum(top) / sum(tot), 10) AS accuracy FROM m
""",
)
def logit_train_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training accuracy from the model summary; with one factor the model predicts each level's modal class."""
    from tabml.operators.inspect import classification_summary

    _, model = _multi_fit(spark, sf_dir)
    acc = classification_summary(model)["accuracy"]
    return spark.range(1).select(F.lit(round(acc, 10)).alias("accuracy"))


_SCORE_X = ["kchars", "lang_en"]


@query(
    "logit_binary_score_eq",
    kind="S",
    sql=f"""
WITH {_DOC_LABELS_SQL}, x AS (SELECT toxic, n_chars / 1000.0 AS kchars, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS lang_en FROM dl)
SELECT 'one' AS term, round(sum(toxic), 3) AS moment FROM x
UNION ALL SELECT 'kchars', round(sum(toxic * kchars), 3) FROM x
UNION ALL SELECT 'lang_en', round(sum(toxic * lang_en), 3) FROM x
""",
)
def logit_binary_score_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default-style binary logistic regression on two features.  At the likelihood optimum the score
    equations hold: Σp = Σy and Σp·x = Σy·x for every feature, so the fitted moments equal the label moments."""
    from pyspark.ml.functions import vector_to_array

    from tabml.operators.models import logistic_regression

    dl = _doc_labels(spark, sf_dir).select(
        "toxic",
        (F.col("n_chars") / 1000.0).alias("kchars"),
        F.when(F.col("lang") == "en", 1.0).otherwise(0.0).alias("lang_en"),
    )
    lr = logistic_regression(label="toxic", tol=1e-12, max_iter=300)
    model = fit_on(Pipeline(stages=[assembler(_SCORE_X), lr]), dl)
    p = vector_to_array("probability")[1]
    m = model.transform(dl).agg(
        F.sum(p).alias("one"), *[F.sum(p * F.col(x)).alias(x) for x in _SCORE_X]
    )
    cols = ["one"] + _SCORE_X
    return m.select(*[F.round(c, 3).alias(c) for c in cols]).unpivot([], cols, "term", "moment")


# --- J05 / J06: forests ----------------------------------------------------------------------------------------------
_STUMP_SQL = """
WITH v AS (SELECT p_size AS x, count(*) AS c, sum(p_retailprice) AS s, sum(p_retailprice * p_retailprice) AS q
           FROM part GROUP BY p_size),
cum AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx,
               sum(c) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS cl,
               sum(s) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS sl,
               sum(q) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS ql FROM v),
tot AS (SELECT sum(c) AS n, sum(s) AS s, sum(q) AS q FROM v),
cand AS (SELECT x, nx, cl, sl, tot.n - cl AS cr, tot.s - sl AS sr,
                (ql - sl * sl / cl) + ((tot.q - ql) - (tot.s - sl) * (tot.s - sl) / (tot.n - cl)) AS sse
         FROM cum, tot WHERE nx IS NOT NULL),
best AS (SELECT * FROM cand ORDER BY sse, x LIMIT 1)
SELECT (x + nx) / 2.0 AS threshold, CAST(cl AS BIGINT) AS n_left, CAST(cr AS BIGINT) AS n_right,
       round(sl / cl, 6) AS left_mean, round(sr / cr, 6) AS right_mean
FROM best
"""


@query("rf_stump_regress", kind="C", sql=_STUMP_SQL)
def rf_stump_regress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unbagged depth-1 regression tree on one feature with a bin per distinct value: the split is the
    least-SSE threshold (midpoint of consecutive values), leaves predict their means.  Leaf statistics are read
    from the scored rows (2 leaves -> 2 rows to the driver)."""
    from tabml.operators.models import random_forest_regressor

    part = load_table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("x"), "p_retailprice")
    rf = random_forest_regressor(
        label="p_retailprice", num_trees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", maxBins=64
    )
    model = fit_on(Pipeline(stages=[assembler(["x"]), rf]), part)
    leaves = (
        model.transform(part)
        .groupBy("prediction")
        .agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    left, right = leaves[0], leaves[-1]
    row = ((left["hi"] + right["lo"]) / 2.0, left["n"], right["n"], round(left["prediction"], 6), round(right["prediction"], 6))
    return spark.createDataFrame([row], "threshold double, n_left bigint, n_right bigint, left_mean double, right_mean double")


def _part_features():
    from tabml.operators.features import FeatureSpec

    return FeatureSpec(numeric=["p_size"], one_hot=["p_brand", "p_type"])


@query("rf_tree_mean", kind="S", sql="SELECT count(*) AS n, round(avg(p_retailprice), 6) AS mean_prediction FROM part")
def rf_tree_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unbagged regression tree (depth 5): every leaf predicts its rows' mean, so the mean training
    prediction equals the mean label."""
    from tabml.operators.features import feature_stages
    from tabml.operators.models import random_forest_regressor

    part = load_table(spark, sf_dir, "part")
    rf = random_forest_regressor(label="p_retailprice", num_trees=1, bootstrap=False, featureSubsetStrategy="all")
    model = fit_on(Pipeline(stages=feature_stages(_part_features()) + [rf]), part)
    return model.transform(part).agg(F.count("*").alias("n"), F.round(F.avg("prediction"), 6).alias("mean_prediction"))


@query(
    "rf_class_priors",
    kind="S",
    sql="SELECT o_orderstatus AS class, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM orders GROUP BY 1",
)
def rf_class_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unbagged classification tree: leaf probabilities are leaf class shares, so the mean training
    probability of each class equals its share of rows."""
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import vector_to_array

    from tabml.operators.models import random_forest_classifier

    o = load_table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_totalprice", F.month("o_orderdate").alias("month")
    )
    idx = StringIndexer(inputCol="o_orderstatus", outputCol="label")
    rf = random_forest_classifier(num_trees=1, bootstrap=False, featureSubsetStrategy="all")
    model = fit_on(Pipeline(stages=[idx, assembler(["o_totalprice", "month"]), rf]), o)
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    scored = model.transform(o).select(F.posexplode(vector_to_array("probability")).alias("k", "p"))
    return scored.groupBy(names[F.col("k")].alias("class")).agg(F.round(F.avg("p"), 8).alias("share"))


# --- J07 / I01 / K09 / K14: k-means -----------------------------------------------------------------------------------
def _planted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with two features where each event type sits in its own band: d1 = type index × S + value,
    d2 = hour, with the band spacing S = 10 × the power of ten above the value range (one scalar aggregate).
    Bands are then more than twice the range apart, so the k-means optimum puts each type in its own cluster
    at any data size."""
    import math

    from tabml.operators.features import string_indexer

    ev = load_table(spark, sf_dir, "events").select("event_type", "value", F.hour("ts").alias("hour"))
    rng = ev.agg((F.max("value") - F.min("value")).alias("r")).first()["r"]
    spacing = float(10 ** math.ceil(math.log10(rng + 1)) * 10)
    idx = string_indexer(["event_type"]).fit(ev).transform(ev)
    return idx.select(
        "event_type",
        (F.col("event_type_index") * spacing + F.col("value")).alias("d1"),
        F.col("hour").cast("double").alias("d2"),
    )


def _planted_sql() -> str:
    from tabml.plans.feature_queries import rank_sql

    return (
        f"{rank_sql('events', 'event_type', 'r')},\n"
        "sp AS (SELECT 10 ^ ceil(log10(max(value) - min(value) + 1)) * 10 AS s FROM events),\n"
        "pe AS (SELECT event_type, r.idx * sp.s + value AS d1, CAST(hour(ts) AS DOUBLE) AS d2 "
        "FROM events JOIN r ON event_type = r.lvl, sp)"
    )


def _planted_fit(spark: SparkSession, sf_dir: str):
    from tabml.operators.models import kmeans

    pe = _planted_events(spark, sf_dir)
    model = fit_on(Pipeline(stages=[assembler(["d1", "d2"]), kmeans(k=5, seed=42, max_iter=20)]), pe)
    return pe, model


@query(
    "kmeans_planted_profile",
    kind="P",
    sql=f"""
WITH {_planted_sql()}
SELECT event_type, count(*) AS size, 1::BIGINT AS n_types, round(avg(d1), 6) AS avg_d1, round(avg(d2), 6) AS avg_d2
FROM pe GROUP BY event_type
""",
)
def kmeans_planted_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means (k=5, seed 42) on planted clusters, then the cluster report: size, purity and feature means per
    cluster.  Clusters are named by their members' event type, never by id."""
    pe, model = _planted_fit(spark, sf_dir)
    return (
        model.transform(pe)
        .groupBy("prediction")
        .agg(
            F.min("event_type").alias("event_type"),
            F.count("*").alias("size"),
            F.count_distinct("event_type").alias("n_types"),
            F.round(F.avg("d1"), 6).alias("avg_d1"),
            F.round(F.avg("d2"), 6).alias("avg_d2"),
        )
        .drop("prediction")
    )


@query(
    "kmeans_centers",
    kind="P",
    sql=f"""
WITH {_planted_sql()}
SELECT event_type, 0 AS dim, round(avg(d1), 6) AS value FROM pe GROUP BY event_type
UNION ALL SELECT event_type, 1, round(avg(d2), 6) FROM pe GROUP BY event_type
""",
)
def kmeans_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster centres as a (cluster, dim, value) table, clusters named through their members."""
    from tabml.operators.inspect import cluster_centers

    pe, model = _planted_fit(spark, sf_dir)
    names = model.transform(pe).groupBy(F.col("prediction").alias("cluster")).agg(F.min("event_type").alias("event_type"))
    cent = cluster_centers(spark, model, ["d1", "d2"])
    return cent.join(names, "cluster").select("event_type", "dim", F.round("value", 6).alias("value"))


@query(
    "eval_wssse",
    kind="P",
    sql=f"""
WITH {_planted_sql()}
SELECT round(sum(n * (v1 + v2)), 2) AS wssse, sum(n)::BIGINT AS n
FROM (SELECT count(*) AS n, var_pop(d1) AS v1, var_pop(d2) AS v2 FROM pe GROUP BY event_type)
""",
)
def eval_wssse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within-cluster sum of squared distances to the fitted centres, one aggregate over the scored rows with
    the (k-row) centre table broadcast; at the planted optimum it is Σ n · var_pop per cluster."""
    from tabml.operators.evaluate import wssse
    from tabml.operators.inspect import last_stage

    pe, model = _planted_fit(spark, sf_dir)
    centers = [c.tolist() for c in last_stage(model).clusterCenters()]
    w = wssse(model.transform(pe), "features", "prediction", centers)
    return w.select(F.round("wssse", 2).alias("wssse"), "n")


@query("kmeans_free_k")
def kmeans_free_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unplanted k-means as the analyses run it: four numeric lineitem columns, k=3, seed 42, maxIter 10;
    cluster sizes and the training cost (rows-only check; properties in tests)."""
    from tabml.operators.inspect import kmeans_summary
    from tabml.operators.models import kmeans

    li = load_table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    model = fit_on(Pipeline(stages=[assembler(li.columns), kmeans(k=3, seed=42, max_iter=10)]), li)
    cost = kmeans_summary(model)["training_cost"]
    return model.transform(li).groupBy("prediction").agg(F.count("*").alias("size")).withColumn(
        "training_cost", F.lit(cost)
    )


@query("rf_regress_10")
def rf_regress_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-tree forest regressor (seed 42) on size + one-hot brand/type -> retail price; hash split 80/20;
    held-out RMSE / R² / MAE (rows-only check)."""
    from tabml.operators.evaluate import regression_metrics
    from tabml.operators.features import feature_stages
    from tabml.operators.models import random_forest_regressor

    part = load_table(spark, sf_dir, "part")
    train, test = hash_split(part, ["p_partkey"], (0.8, 0.2), seed=42)
    pipe = Pipeline(stages=feature_stages(_part_features()) + [random_forest_regressor(label="p_retailprice")])
    model = fit_on(pipe, train, persist=True)
    m = regression_metrics(model.transform(test), "p_retailprice", "prediction")
    return m.select("n", "rmse", "r2", "mae")


@query("rf_classify_10")
def rf_classify_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-tree forest classifier (seed 42): part type from size, price and one-hot brand; held-out accuracy
    and weighted F1 (rows-only check)."""
    from pyspark.ml.feature import StringIndexer

    from tabml.operators.evaluate import classification_metrics
    from tabml.operators.features import FeatureSpec, feature_stages
    from tabml.operators.models import random_forest_classifier

    part = load_table(spark, sf_dir, "part")
    train, test = hash_split(part, ["p_partkey"], (0.8, 0.2), seed=42)
    spec = FeatureSpec(numeric=["p_size", "p_retailprice"], one_hot=["p_brand"], handle_invalid="skip")
    stages = [StringIndexer(inputCol="p_type", outputCol="label", handleInvalid="skip")] + feature_stages(spec)
    model = fit_on(Pipeline(stages=stages + [random_forest_classifier()]), train, persist=True)
    return classification_metrics(model.transform(test), "label", "prediction")


_MULTI_SCORE_X = ["l_quantity", "disc", "tax"]


@query(
    "logit_multi_score_eq",
    kind="S",
    sql="""
WITH x AS (SELECT l_returnflag AS class, l_quantity, l_discount * 100 AS disc, l_tax * 100 AS tax FROM lineitem)
SELECT class, 'one' AS term, CAST(count(*) AS DOUBLE) AS moment FROM x GROUP BY class
UNION ALL SELECT class, 'l_quantity', round(sum(l_quantity), 1) FROM x GROUP BY class
UNION ALL SELECT class, 'disc', round(sum(disc), 1) FROM x GROUP BY class
UNION ALL SELECT class, 'tax', round(sum(tax), 1) FROM x GROUP BY class
""",
)
def logit_multi_score_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multinomial logistic regression (3 classes, 3 features) fitted to convergence.  At the optimum, for every
    class k and feature j, Σ p_k · x_j = Σ [y = k] · x_j (and Σ p_k = n_k): the fitted moments per class equal
    the observed ones.  Moments are summed over the scored rows with the class names mapped back."""
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import vector_to_array

    from tabml.operators.models import logistic_regression

    li = load_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_quantity", (F.col("l_discount") * 100).alias("disc"), (F.col("l_tax") * 100).alias("tax")
    )
    idx = StringIndexer(inputCol="l_returnflag", outputCol="label")
    lr = logistic_regression(family="multinomial", tol=1e-12, max_iter=300)
    model = fit_on(Pipeline(stages=[idx, assembler(_MULTI_SCORE_X), lr]), li)
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    scored = model.transform(li).select(*_MULTI_SCORE_X, F.posexplode(vector_to_array("probability")).alias("k", "p"))
    sums = scored.groupBy(names[F.col("k")].alias("class")).agg(
        F.round(F.sum("p"), 1).alias("one"), *[F.round(F.sum(F.col("p") * F.col(x)), 1).alias(x) for x in _MULTI_SCORE_X]
    )
    return sums.unpivot(["class"], ["one"] + _MULTI_SCORE_X, "term", "moment")
