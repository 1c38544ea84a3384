"""The 20 composite analyses as job specifications over the fixture tables, one ``job_<id>`` query per task.

Each source does the cleaning the analysis needs (derived columns, range / set filters, safe casts) as one
DataFrame plan; the runner does split, features, fit, score and metrics.  Model quality on synthetic fixtures is
not meaningful, so these queries are checked on rows (one metric row per reported number) and by the
properties in ``tests/``; the operators they use are checked exactly by the other queries.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions import NUMERIC_TEXT_PATTERN, parse_duration, ratio, safe_double
from tabml.operators.features import FeatureSpec
from tabml.operators.relational import not_null
from tabml.plans.catalog import query
from tabml.plans.jobs import JobSpec, TaskSpec, run_job
from tabml.plans.sqlgen import EDGE_70, EDGE_80, hashed_sql, ols_ctes, ols_gauss_ctes, ols_prediction, unit_sql
from tabml.sources import load_table

# Metric values of the registered job queries are reported to this many significant digits (counts exact).
DIGITS = 6


# --- sources ---------------------------------------------------------------------------------------------------------
def lineitem_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year"),
    )


def events_source(spark: SparkSession, sf_dir: str, max_seconds: int | None = None) -> DataFrame:
    """Trip-like events: a duration (ten seconds for each unit of the event's value) parsed from `000 days HH:MM:SS` text, hour /
    weekday / month of the start, and the cleaning filters (positive duration, known event types, optional longest trip
    in seconds)."""
    ev = load_table(spark, sf_dir, "events")
    sec = F.floor(F.col("value") * 10).cast("int")
    txt = F.format_string("000 days %02d:%02d:%02d", F.floor(sec / 3600).cast("int"), F.floor(sec / 60).cast("int") % 60, sec % 60)
    df = ev.select(
        "event_id",
        F.col("user_id").cast("double").alias("user_id"),
        "value",
        parse_duration(txt).alias("duration_sec"),
        F.hour("ts").alias("hour"),
        F.dayofweek("ts").alias("day_of_week"),
        F.month("ts").alias("month"),
        F.when(F.col("event_type") == "click", "click").otherwise("other").alias("is_click"),
        "event_type",
    )
    cond = (F.col("duration_sec") > 0) & F.col("event_type").isin(
        "click", "view", "purchase", "signup", "error"
    )
    if max_seconds is not None:
        cond = cond & (F.col("duration_sec") <= max_seconds)
    return df.filter(cond)


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load_table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_totalprice", "o_orderstatus",
        F.month("o_orderdate").alias("month"), F.dayofweek("o_orderdate").alias("day_of_week"),
    )


def orders_trimmed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomaly trim before clustering (price band, key band)."""
    o = orders_source(spark, sf_dir)
    return o.filter((F.col("o_totalprice") > 1000) & (F.col("o_totalprice") < 4.5e5) & (F.col("o_custkey") > 0))


def part_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "part").na.drop()


def customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insured-person-like rows: a charge, two numeric inputs, a region and two binary text columns."""
    c = load_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"), "c_mktsegment",
        (F.col("c_custkey") % 7).cast("double").alias("c_keyband"),
        F.when(F.col("c_custkey") % 2 == 0, "f").otherwise("m").alias("sex"),
        F.when((F.col("c_custkey") % 5 == 0) | (F.col("c_acctbal") > 8500), "yes").otherwise("no").alias("smoker"),
    )


def doc_labels_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = load_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("toxic")
    )
    return docs.join(labels, "doc_id")


def channel_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel-like rows: numbers that arrive as text (guarded casts: what is no plain number is NULL), a category, NULL
    rows removed, a ratio of the two numbers and its filter.  All tasks and reports of the analysis read this frame."""
    c = load_table(spark, sf_dir, "customer")
    text = c.select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("country"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("subscribers_text"),
        F.col("c_custkey").cast("string").alias("views_text"),
    )
    numbers = text.select(
        "c_custkey", "country", safe_double("subscribers_text", NUMERIC_TEXT_PATTERN).alias("subscribers"),
        safe_double("views_text", NUMERIC_TEXT_PATTERN).alias("views"),
    )
    clean = not_null(numbers, ["subscribers", "views", "country"]).withColumn("views_per_subscriber", ratio("views", "subscribers"))
    return clean.filter(F.col("views_per_subscriber") > 0)


# --- job specifications --------------------------------------------------------------------------------------------
# Fixed values (the analyses' own parameters, kept as they were):
#   split weights 0.7/0.3 (iris, avocado, bike, bike2, medical) and 0.8/0.2 (cars, youtube), seed 42;
#   logistic regression maxIter 10 for the multiclass tasks, library default (100) for the binary ones;
#   linear regression maxIter 10 for bike, bike2 and youtube, default elsewhere;
#   random forests 10 trees, seed 42;
#   k-means seed 42 with k = 3 (iris, maxIter 10), 3 (avocado), 5 (bike, bike2), 3 (cars), 3 (medical),
#   4 (youtube, maxIter 20); avocado clusters on std-scaled features, youtube on centred and scaled ones;
#   the youtube classifier keeps the 5 most frequent classes, its clustering rows in fixed ranges.
_LI4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Split unit for lineitem: the order line, so one very large order cannot tilt the train/test proportions.
_LI_KEYS = ["l_orderkey", "l_linenumber"]
_LI_ALL = ["l_quantity", "l_discount", "l_tax", "ship_year", "l_partkey", "l_suppkey", "l_linenumber"]

IRIS = JobSpec(
    "iris", lineitem_source, _LI_KEYS,
    [
        TaskSpec("iris_clf", "classification", FeatureSpec(numeric=_LI4), "l_returnflag", "logistic",
                 {"maxIter": 10}, reports=("sample_rows",)),
        TaskSpec("iris_clu", "clustering", FeatureSpec(numeric=_LI4), None, "kmeans",
                 {"k": 3, "maxIter": 10}, fit_scope="all", eval_split="all", reports=("silhouette", "centers", "sample_rows"),
                 profile_by="l_returnflag"),
    ],
    report_split_sizes=True,
)

AVOCADO = JobSpec(
    "avocado", lineitem_source, _LI_KEYS,
    [
        TaskSpec("avocado_clf", "classification", FeatureSpec(numeric=_LI_ALL + ["l_extendedprice"], output="features_clf"),
                 "l_linestatus", "logistic", binary=True),
        TaskSpec("avocado_reg", "regression", FeatureSpec(numeric=_LI_ALL, output="features_reg"), "l_extendedprice",
                 "linear"),
        TaskSpec("avocado_clu", "clustering",
                 FeatureSpec(numeric=["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_year"],
                             output="scaled_features", scale="std"),
                 None, "kmeans", {"k": 3}, fit_scope="all", eval_split="all",
                 reports=("silhouette", "cluster_means"), profile_by="l_linestatus"),
    ],
)

_BIKE_CLF = FeatureSpec(numeric=["user_id", "duration_sec", "hour", "day_of_week"])
BIKE = JobSpec(
    "bike", events_source, ["event_id"],
    [
        TaskSpec("bike_clf", "classification", _BIKE_CLF, "is_click", "logistic", binary=True),
        TaskSpec("bike_clu", "clustering", _BIKE_CLF, None, "kmeans", {"k": 5}, fit_scope="all", eval_split="all"),
        TaskSpec("bike_reg", "regression", FeatureSpec(numeric=["user_id", "hour", "day_of_week"], output="reg_features"),
                 "duration_sec", "linear", {"maxIter": 10}, reports=("train_summary",)),
    ],
    profile_cols=("user_id", "duration_sec", "hour", "is_click"),
)

BIKE2 = JobSpec(
    "bike2", lambda s, d: events_source(s, d, max_seconds=3600), ["event_id"],
    [
        TaskSpec("bike2_clf", "classification", _BIKE_CLF, "is_click", "logistic", binary=True),
        TaskSpec("bike2_clu", "clustering", _BIKE_CLF, None, "kmeans", {"k": 5}, fit_scope="all", eval_split="all",
                 reports=("centers",)),
        TaskSpec("bike2_reg", "regression",
                 FeatureSpec(numeric=["user_id", "hour", "day_of_week", "month"], output="reg_features"), "duration_sec",
                 "linear", {"maxIter": 10, "tol": 1e-12}, reports=("coefficients", "label_stats", "banded", "sample_rows"),
                 band_col="hour", band_bounds=(6, 12, 18), sample="hash"),
    ],
    profile_cols=("user_id", "duration_sec", "hour", "is_click"),
)

ORDERS_REG = JobSpec(
    "orders_reg", orders_source, ["o_orderkey"],
    [
        TaskSpec("orders_reg", "regression",
                 FeatureSpec(numeric=["o_custkey", "month", "day_of_week"], output="reg_features"),
                 "o_totalprice", "linear", {"maxIter": 10},
                 reports=("coefficients", "label_stats", "banded"), band_col="month", band_bounds=(4, 7, 10)),
    ],
)

_CARS = FeatureSpec(numeric=["p_size"], one_hot=["p_brand", "p_type"], handle_invalid="skip")
CARS = JobSpec(
    "cars", part_source, ["p_partkey"],
    [
        TaskSpec("cars_reg", "regression", _CARS, "p_retailprice", "forest", {"numTrees": 10, "seed": 42}),
        TaskSpec("cars_clf", "classification",
                 FeatureSpec(numeric=["p_size", "p_retailprice"], one_hot=["p_brand"], handle_invalid="skip",
                             output="classifier_features"),
                 "p_type", "forest", {"numTrees": 10, "seed": 42}, reports=("sample_rows",)),
        TaskSpec("cars_clu", "clustering", _CARS, None, "kmeans", {"k": 3}, reports=("silhouette",)),
    ],
    weights=(0.8, 0.2),
)

MEDICAL = JobSpec(
    "medical", customer_source, ["c_custkey"],
    [
        TaskSpec("medical_reg", "regression",
                 FeatureSpec(numeric=["c_nationkey", "c_keyband"], indexed=["sex", "smoker"], one_hot=["c_mktsegment"]),
                 "c_acctbal", "linear"),
        TaskSpec("medical_clu", "clustering",
                 FeatureSpec(numeric=["c_acctbal", "c_nationkey", "c_keyband"], output="cluster_features"),
                 None, "kmeans", {"k": 3}, fit_scope="all", eval_split="all",
                 reports=("silhouette", "wssse", "centers")),
        TaskSpec("medical_clf", "classification",
                 FeatureSpec(numeric=["c_acctbal", "c_nationkey", "c_keyband"], one_hot=["sex", "c_mktsegment"],
                             output="features_class"),
                 "smoker", "logistic", binary=True, reports=("auc", "class_balance", "contingency", "fit_status", "sample_rows")),
    ],
    profile_cols=("c_acctbal", "c_mktsegment"),
)

DOCLABELS_CLF = JobSpec(
    "doclabels_clf", doc_labels_source, ["doc_id"],
    [
        TaskSpec("doclabels_clf", "classification",
                 FeatureSpec(numeric=["n_chars"], one_hot=["lang", "source"], output="features_class"),
                 "toxic", "logistic", binary=True, reports=("auc", "class_balance")),
    ],
)

YOUTUBE = JobSpec(
    "youtube", channel_source, ["c_custkey"],
    [
        TaskSpec("youtube_reg", "regression", FeatureSpec(numeric=["views"], output="features_reg"), "subscribers",
                 "linear", {"maxIter": 10, "predictionCol": "predicted_subscribers"}, reports=("train_summary", "sample_rows")),
        TaskSpec("youtube_clf", "classification",
                 FeatureSpec(numeric=["subscribers", "views", "views_per_subscriber"], output="features_clf"),
                 "country", "logistic", {"maxIter": 10, "predictionCol": "predicted_country"},
                 reports=("train_accuracy", "coefficients", "contingency"), top_classes=5),
        TaskSpec("youtube_clu", "clustering",
                 FeatureSpec(numeric=["subscribers", "views", "views_per_subscriber"], output="features_cluster",
                             scale="zscore"),
                 None, "kmeans", {"k": 4, "maxIter": 20, "predictionCol": "cluster"}, fit_scope="all",
                 eval_split="all", reports=("centers", "cluster_means"),
                 where="subscribers > 1000 AND subscribers < 1e8 AND views < 1e10"),
    ],
    weights=(0.8, 0.2),
    profile_cols=("subscribers", "views", "views_per_subscriber", "country"),
    top_report=("subscribers", 10),
    top_groups=("country", 10),
)

PRICE_REG = JobSpec(
    "price_reg", lineitem_source, _LI_KEYS,
    [
        TaskSpec("price_reg", "regression", FeatureSpec(numeric=["l_quantity"], output="features_reg"),
                 "l_extendedprice", "linear", {"maxIter": 10, "predictionCol": "predicted_price"},
                 reports=("train_summary",)),
    ],
    weights=(0.8, 0.2),
)

TRIMMED_CLU = JobSpec(
    "trimmed_clu", orders_trimmed_source, ["o_orderkey"],
    [
        TaskSpec("trimmed_clu", "clustering",
                 FeatureSpec(numeric=["o_totalprice", "o_custkey", "month"], output="features_cluster", scale="zscore"),
                 None, "kmeans", {"k": 4, "maxIter": 20, "predictionCol": "cluster"}, fit_scope="all",
                 eval_split="all", reports=("centers", "cluster_means")),
    ],
)

#: The analyses (20 tasks), and further one-task jobs on other tables.
JOBS = [IRIS, AVOCADO, BIKE, BIKE2, CARS, MEDICAL, YOUTUBE]
MORE_JOBS = [ORDERS_REG, DOCLABELS_CLF, PRICE_REG, TRIMMED_CLU]
JOB_BY_NAME = {j.name: j for j in JOBS + MORE_JOBS}


def task_job(task_name: str) -> JobSpec:
    """One task of its analysis as a job of its own (job-level source reports belong to whole-job runs)."""
    for job in JOBS + MORE_JOBS:
        for t in job.tasks:
            if t.name == task_name:
                return replace(job, tasks=[t], report_split_sizes=False, profile_cols=(), top_report=None, top_groups=None)
    raise KeyError(task_name)


# --- closed-form oracles for the least-squares jobs ------------------------------------------------------------------
def _sig_sql(v: str, digits: int = DIGITS) -> str:
    """DuckDB twin of ``round_sig``: significant digits, whole numbers kept."""
    return (
        f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} = floor({v}) THEN {v} "
        f"ELSE round({v}, CAST({digits - 1} - floor(log10(abs({v}))) AS INTEGER)) END"
    )


def _reg_metrics_sql(test: str, train: str | None, features: list[str]) -> list[tuple[str, str, str]]:
    """(split, metric, value-expression-query) rows: held-out regression metrics, optional training R² / RMSE."""
    p = ols_prediction(features)
    rows = [
        ("test", "n", f"SELECT CAST(count(*) AS DOUBLE) FROM {test}"),
        ("test", "rmse", f"SELECT sqrt(avg((y - {p}) ^ 2)) FROM {test}, ols_b"),
        ("test", "mse", f"SELECT avg((y - {p}) ^ 2) FROM {test}, ols_b"),
        ("test", "mae", f"SELECT avg(abs(y - {p})) FROM {test}, ols_b"),
        ("test", "r2", f"SELECT 1 - avg((y - {p}) ^ 2) / var_pop(y) FROM {test}, ols_b"),
        ("test", "mape", f"SELECT avg(CASE WHEN y <> 0 THEN abs((y - {p}) / y) END) * 100 FROM {test}, ols_b"),
        ("test", "mape_excluded", f"SELECT CAST(count_if(y IS NULL OR y = 0) AS DOUBLE) FROM {test}"),
        ("test", "rows_skipped", "SELECT 0::DOUBLE"),
    ]
    if train:
        rows += [
            ("train", "r2", f"SELECT 1 - avg((y - {p}) ^ 2) / var_pop(y) FROM {train}, ols_b"),
            ("train", "rmse", f"SELECT sqrt(avg((y - {p}) ^ 2)) FROM {train}, ols_b"),
        ]
    return rows


def _job_sql(job: str, ctes: str, rows: list[tuple[str, str, str]], task: str | None = None, more: str = "") -> str:
    """(split, metric, scalar query) rows as one statement; ``more`` adds UNION ALL branches of its own."""
    body = "\nUNION ALL ".join(
        f"SELECT '{split}' AS split, '{metric}' AS metric, ({q}) AS value" for split, metric, q in rows
    ) + f"\n{more}"
    return (
        f"WITH {ctes}\nSELECT '{job}' AS job, '{task or job}' AS task, split, metric, {_sig_sql('value')} AS value "
        f"FROM (\n{body}\n)"
    )


def _price_reg_sql() -> str:
    src = hashed_sql("lineitem", [("l_orderkey", "bigint"), ("l_linenumber", "int")])
    ctes = (
        f"s AS (SELECT l_quantity AS x1, l_extendedprice AS y, {unit_sql('_h')} AS u FROM {src}),\n"
        f"tr AS (SELECT * FROM s WHERE u < {EDGE_80}), te AS (SELECT * FROM s WHERE u >= {EDGE_80}),\n"
        + ols_ctes("tr", ["x1"], "y")
    )
    return _job_sql("price_reg", ctes, _reg_metrics_sql("te", "tr", ["x1"]))


_CHANNEL_SQL = """
(SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS country, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS subscribers,
        CAST(c_custkey AS DOUBLE) AS views FROM customer
 WHERE regexp_matches(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), '^[0-9.]+$') AND c_acctbal <> 0 AND c_custkey <> 0
   AND c_nationkey IS NOT NULL)"""


def _shown_sql(key: str) -> str:
    """Sample rows (CTE ``shown`` of key, y and prediction p)."""
    return " ".join(
        f"UNION ALL SELECT 'test' AS split, 'sample_' || {key} || '_{what}' AS metric, {v} AS value FROM shown"
        for what, v in (("actual", "y"), ("predicted", "p"), ("abs_error", "abs(y - p)"))
    )


def _youtube_reg_sql() -> str:
    src = hashed_sql(_CHANNEL_SQL, [("c_custkey", "bigint")])
    ctes = (
        f"s AS (SELECT c_custkey, views AS x1, subscribers AS y, {unit_sql('_h')} AS u FROM {src}),\n"
        f"tr AS (SELECT * FROM s WHERE u < {EDGE_80}), te AS (SELECT * FROM s WHERE u >= {EDGE_80}),\n"
        + ols_ctes("tr", ["x1"], "y")
    )
    ctes += f",\nshown AS (SELECT c_custkey, y, {ols_prediction(['x1'])} AS p FROM te, ols_b ORDER BY c_custkey LIMIT 10)"
    return _job_sql("youtube", ctes, _reg_metrics_sql("te", "tr", ["x1"]), task="youtube_reg", more=_shown_sql("c_custkey"))


_EVENTS_CLEAN_SQL = """
SELECT *, hour(ts) AS hour FROM (
  SELECT event_id, event_type, ts, CAST(user_id AS DOUBLE) AS x1, CAST(hour(ts) AS DOUBLE) AS x2,
         CAST(dayofweek(ts) + 1 AS DOUBLE) AS x3, CAST(floor(value * 10) AS INTEGER) AS duration_sec,
         CAST(floor(value * 10) AS DOUBLE) AS y
  FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'error'))
WHERE duration_sec > 0"""


def _events_parts(trim: str = "") -> str:
    src = hashed_sql(f"({_EVENTS_CLEAN_SQL} {trim})", [("event_id", "bigint")])
    return (
        f"s AS (SELECT *, {unit_sql('_h')} AS u FROM {src}),\n"
        f"tr AS (SELECT * FROM s WHERE u < {EDGE_70}), te AS (SELECT * FROM s WHERE u >= {EDGE_70}),\n"
    )


def _bike_reg_sql() -> str:
    ctes = _events_parts() + ols_ctes("tr", ["x1", "x2", "x3"], "y")
    return _job_sql("bike", ctes, _reg_metrics_sql("te", "tr", ["x1", "x2", "x3"]), task="bike_reg")


def _banded_reg_rows(feats: list[str], names: list[str], bands: list[str]) -> list[tuple[str, str, str]]:
    """Metrics of a regression with coefficients, label statistics and errors by band (CTE ``bands``)."""
    rows = _reg_metrics_sql("te", None, feats)
    rows += [("train", f"coef_{n}", f"SELECT b_{i} FROM ols_b") for i, n in enumerate(names, 1)]
    rows += [("train", "intercept", "SELECT b_0 FROM ols_b")]
    rows += [("all", f"label_{k}", f"SELECT {f}(y) FROM s")
             for k, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]
    rows += [("test", "rmse_std_ratio",
              f"SELECT sqrt(avg((y - {ols_prediction(feats)}) ^ 2)) / (SELECT stddev_samp(y) FROM s) FROM te, ols_b")]
    for b in bands:
        rows += [("test", f"mae_band_{b}", f"SELECT avg(ae) FROM bands WHERE band = '{b}'"),
                 ("test", f"n_band_{b}", f"SELECT CAST(count(*) AS DOUBLE) FROM bands WHERE band = '{b}'")]
    return rows


def _bike2_reg_sql() -> str:
    feats = ["x1", "x2", "x3"]
    pred = ols_prediction(feats)
    ctes = (
        _events_parts("AND duration_sec <= 3600") + ols_ctes("tr", feats, "y")
        + ",\nbands AS (SELECT CASE WHEN x2 < 6 THEN '<6' WHEN x2 < 12 THEN '[6,12)' WHEN x2 < 18 THEN '[12,18)' "
        f"ELSE '>=18' END AS band, abs(y - {pred}) AS ae FROM te, ols_b),\n"
        f"shown AS (SELECT event_id, y, {pred} AS p FROM {hashed_sql('te', [('event_id', 'bigint')], seed=43, out='_h2')}, ols_b ORDER BY _h2, event_id LIMIT 10)"
    )
    rows = _banded_reg_rows(feats, ["user_id", "hour", "day_of_week"], ["<6", "[6,12)", "[12,18)", ">=18"])
    # the events lie in one month, and the fit leaves a constant column out
    rows += [("train", "coef_month", "SELECT CASE WHEN count(DISTINCT month(ts)) = 1 THEN 0::DOUBLE END FROM tr")]
    return _job_sql("bike2", ctes, rows, task="bike2_reg", more=_shown_sql("event_id"))


def _orders_reg_sql() -> str:
    feats = ["x1", "x2", "x3"]
    src = hashed_sql("orders", [("o_orderkey", "bigint")])
    ctes = (
        f"s AS (SELECT CAST(o_custkey AS DOUBLE) AS x1, month(o_orderdate) AS x2, dayofweek(o_orderdate) + 1 AS x3,"
        f" o_totalprice AS y, {unit_sql('_h')} AS u FROM {src}),\n"
        f"tr AS (SELECT * FROM s WHERE u < {EDGE_70}), te AS (SELECT * FROM s WHERE u >= {EDGE_70}),\n"
        + ols_ctes("tr", feats, "y")
        + ",\nbands AS (SELECT CASE WHEN x2 < 4 THEN '<4' WHEN x2 < 7 THEN '[4,7)' WHEN x2 < 10 THEN '[7,10)' "
        f"ELSE '>=10' END AS band, abs(y - {ols_prediction(feats)}) AS ae FROM te, ols_b)"
    )
    rows = _banded_reg_rows(feats, ["o_custkey", "month", "day_of_week"], ["<4", "[4,7)", "[7,10)", ">=10"])
    return _job_sql("orders_reg", ctes, rows)


def _avocado_reg_sql() -> str:
    feats = [f"x{i}" for i in range(1, 8)]
    src = hashed_sql("lineitem", [("l_orderkey", "bigint"), ("l_linenumber", "int")])
    ctes = (
        "s AS (SELECT l_quantity AS x1, l_discount AS x2, l_tax AS x3, year(l_shipdate) AS x4, l_partkey AS x5,"
        f" l_suppkey AS x6, l_linenumber AS x7, l_extendedprice AS y, {unit_sql('_h')} AS u FROM {src}),\n"
        f"tr AS (SELECT * FROM s WHERE u < {EDGE_70}), te AS (SELECT * FROM s WHERE u >= {EDGE_70}),\n"
        + ols_gauss_ctes("tr", feats, "y")
    )
    return _job_sql("avocado", ctes, _reg_metrics_sql("te", None, feats), task="avocado_reg")


def _medical_reg_sql() -> str:
    from tabml.plans.feature_queries import one_hot_sql, rank_sql

    feats = ["x1", "x2", "x3", "x4", "d0", "d1", "d2", "d3"]
    src = hashed_sql("customer", [("c_custkey", "bigint")])
    ctes = (
        "s AS (SELECT CAST(c_nationkey AS DOUBLE) AS x1, CAST(c_custkey % 7 AS DOUBLE) AS x2, c_mktsegment,"
        " CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS sex,"
        " CASE WHEN c_custkey % 5 = 0 OR c_acctbal > 8500 THEN 'yes' ELSE 'no' END AS smoker,"
        f" c_acctbal AS y, {unit_sql('_h')} AS u FROM {src}),\n"
        f"tr0 AS (SELECT * FROM s WHERE u < {EDGE_70}), te0 AS (SELECT * FROM s WHERE u >= {EDGE_70}),\n"
        f"{rank_sql('tr0', 'c_mktsegment', 'r')},\n{rank_sql('tr0', 'sex', 'a')},\n{rank_sql('tr0', 'smoker', 'b')},\n"
        + "".join(
            f"{p} AS (SELECT {p}0.*, a.idx AS x3, b.idx AS x4, {one_hot_sql('r.idx', 4, 'd')} FROM {p}0"
            " JOIN r ON c_mktsegment = r.lvl JOIN a ON sex = a.lvl JOIN b ON smoker = b.lvl),\n"
            for p in ("tr", "te")
        )
        + ols_gauss_ctes("tr", feats, "y")
    )
    return _job_sql("medical", ctes, _reg_metrics_sql("te", None, feats), task="medical_reg")


JOB_ORACLES = {
    "price_reg": _price_reg_sql,
    "orders_reg": _orders_reg_sql,
    "youtube_reg": _youtube_reg_sql,
    "bike_reg": _bike_reg_sql,
    "bike2_reg": _bike2_reg_sql,
    "avocado_reg": _avocado_reg_sql,
    "medical_reg": _medical_reg_sql,
}


def _register(task_name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_job(spark, task_job(task_name), sf_dir, digits=DIGITS)

    run.__name__ = f"job_{task_name}"
    run.__doc__ = f"Composite analysis task {task_name}: metric rows (job, task, split, metric, value)."
    builder = JOB_ORACLES.get(task_name)
    query(f"job_{task_name}", sql=builder() if builder else None, kind="C")(run)


for _job in JOBS + MORE_JOBS:
    for _t in _job.tasks:
        _register(_t.name)


def _register_whole(job: JobSpec) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_job(spark, job, sf_dir, digits=DIGITS)

    run.__name__ = f"job_{job.name}_all"
    run.__doc__ = (
        f"All tasks of analysis {job.name} in one run: the cleaned source is persisted once and shared, feature "
        "models are fitted once per feature spec."
    )
    query(f"job_{job.name}_all")(run)


for _job in JOBS:
    if len(_job.tasks) > 1:
        _register_whole(_job)


# --- whole analyses: the parts with a closed form, taken from the whole run -------------------------------------------
def _profile_sql(job: str, source: str, numeric: dict[str, str], text: dict[str, str], top: tuple[str, int, str] | None = None, groups: tuple[str, int] | None = None) -> str:
    """Job-level reports on a cleaned source: ``numeric`` and ``text`` name the columns' expressions."""
    rows = [f"SELECT '{stat}_{c}' AS metric, CAST({f}({e}) AS DOUBLE) AS value FROM src"
            for c, e in numeric.items()
            for stat, f in (("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"))]
    rows += [f"SELECT '{stat}_{c}' AS metric, CAST(count({d}{e}) AS DOUBLE) AS value FROM src"
             for c, e in text.items() for stat, d in (("count", ""), ("distinct", "DISTINCT "))]
    if top:
        col, n, key = top
        rows.append(f"SELECT 'top' || row_number() OVER (ORDER BY {col} DESC, {key}) || '_{col}_' || {key} AS metric, {col} AS value FROM src ORDER BY {col} DESC, {key} LIMIT {n}")
    if groups:
        col, n = groups
        rows.append(f"SELECT 'top' || row_number() OVER (ORDER BY count(*) DESC, {col}) || '_n_{col}_' || {col} AS metric, count(*)::DOUBLE AS value FROM src GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT {n}")
    body = "\nUNION ALL ".join(f"({q})" for q in rows)
    return f"WITH src AS (SELECT * FROM {source}) SELECT '{job}' AS job, 'source' AS task, 'all' AS split, metric, {_sig_sql('value')} AS value FROM ({body})"


_EVENT_NUMBERS = {"user_id": "x1", "duration_sec": "duration_sec", "hour": "x2"}
_EVENT_TEXT = {"is_click": "CASE WHEN event_type = 'click' THEN 'click' ELSE 'other' END"}
_WHOLE = {
    "bike": ("bike_reg", _bike_reg_sql, _profile_sql("bike", f"({_EVENTS_CLEAN_SQL})", _EVENT_NUMBERS, _EVENT_TEXT)),
    "bike2": ("bike2_reg", _bike2_reg_sql, _profile_sql("bike2", f"({_EVENTS_CLEAN_SQL} AND duration_sec <= 3600)", _EVENT_NUMBERS, _EVENT_TEXT)),
    "medical": ("medical_reg", _medical_reg_sql, _profile_sql("medical", "customer", {"c_acctbal": "c_acctbal"}, {"c_mktsegment": "c_mktsegment"})),
    "youtube": (
        "youtube_reg", _youtube_reg_sql,
        _profile_sql("youtube", f"(SELECT *, views / subscribers AS views_per_subscriber FROM {_CHANNEL_SQL})",
                     {c: c for c in ("subscribers", "views", "views_per_subscriber")}, {"country": "country"}, ("subscribers", 10, "c_custkey"), ("country", 10)),
    ),
}


def _register_fixed(name: str, task: str, task_sql: str, source_sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        whole = run_job(spark, JOB_BY_NAME[name], sf_dir, digits=DIGITS)
        return whole.filter(F.col("task").isin("source", task))

    run.__name__ = f"job_{name}_all_fixed"
    run.__doc__ = f"Analysis {name} run whole: its source reports and least-squares task."
    query(f"job_{name}_all_fixed", sql=f"SELECT * FROM ({task_sql}) UNION ALL SELECT * FROM ({source_sql})", kind="C")(run)


for _name, (_task, _sql, _source_sql) in _WHOLE.items():
    _register_fixed(_name, _task, _sql(), _source_sql)
