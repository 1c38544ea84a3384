"""Exact companions of the composite analyses: the same runner, splits, estimators and reports, on whole tables, with
inputs for which the fitted model has a closed form, so that every reported number has an oracle.

* Classification: one category that follows the label except on every tenth key.  At the logistic optimum (and in the
  leaves of an unbagged tree) a level's probabilities are its class shares in the train part.
* Forest regression: an unbagged tree on a few values; leaves are their train means.
* Clustering: three bands far apart of clearly different sizes; the optimum is one cluster per band.

Sources are SQL expressions that Spark and DuckDB both evaluate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabml.operators.features import FeatureSpec
from tabml.plans.catalog import query
from tabml.plans.evaluate_queries import _weighted_sql
from tabml.plans.feature_queries import rank_sql
from tabml.plans.job_queries import DIGITS, _job_sql
from tabml.plans.jobs import JobSpec, TaskSpec, run_job
from tabml.plans.sqlgen import EDGE_70, EDGE_80, hashed_sql, unit_sql
from tabml.sources import load_table


def _source(table: str, columns: dict[str, str], where: str | None):
    def source(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = load_table(spark, sf_dir, table)
        return (df.filter(where) if where else df).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])

    return source


def _parts_sql(table: str, columns: dict[str, str], where: str | None, keys: list[tuple[str, str]], weights: tuple[float, float]) -> str:
    inner = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    src = hashed_sql(f"(SELECT {inner} FROM {table}{f' WHERE {where}' if where else ''})", keys)
    edge = EDGE_80 if weights[0] == 0.8 else EDGE_70
    return f"s AS (SELECT *, {unit_sql('_h')} AS u FROM {src}),\ntr AS (SELECT * FROM s WHERE u < {edge}), te AS (SELECT * FROM s WHERE u >= {edge})"


def _follows(label: str, key: str, cycle: list[str]) -> str:
    """The label itself, or on every tenth key the next one of the cycle."""
    turns = " ".join(f"WHEN {label} = '{a}' THEN '{b}'" for a, b in zip(cycle, cycle[1:] + cycle[:1]))
    return f"CASE WHEN {key} % 10 < 9 THEN {label} ELSE CASE {turns} END END"


def _register(name: str, job: JobSpec, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_job(spark, job, sf_dir, digits=DIGITS).filter("metric != 'iterations'")

    run.__name__, run.__doc__ = name, f"Exact companion of {job.tasks[0].name}: {__doc__.splitlines()[0]}"
    query(name, sql=sql, kind="P" if job.tasks[0].kind == "clustering" else "C")(run)


# --- classification --------------------------------------------------------------------------------------------------
def _classification(name: str, table: str, keys: list[tuple[str, str]], label: str, cycle: list[str], weights=(0.7, 0.3), where: str | None = None,
                    binary: bool = False, forest: bool = False, max_iter: int = 100) -> None:
    key = keys[0][0]
    columns = {k: k for k, _ in keys} | {"y": label, "f": _follows(label, key, cycle)}
    spec = FeatureSpec(one_hot=["f"])
    params: dict = {"maxIter": max_iter}
    if forest:
        columns["f"] = "CASE " + " ".join(f"WHEN {columns['f']} = '{c}' THEN {i}.0" for i, c in enumerate(cycle)) + " END"
        columns["f"] = f"CAST({columns['f']} AS DOUBLE)"
        spec = FeatureSpec(numeric=["f"])
        params = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 6, "seed": 42}
    reports = ("contingency", "class_balance") + (("auc",) if binary else ())
    task = TaskSpec(f"{name}_exact", "classification", spec, "y", "forest" if forest else "logistic", params, binary=binary, reports=reports)
    job = JobSpec(f"{name}_exact", _source(table, columns, where), [k for k, _ in keys], [task], weights=weights)
    ctes = (
        _parts_sql(table, columns, where, keys, weights)
        + f",\n{rank_sql('tr', 'y', 'lab')},\n"
        "share AS (SELECT f, y, count(*) AS c FROM tr GROUP BY f, y),\n"
        "best AS (SELECT f, arg_max(y, c) AS p, sum(CASE WHEN lab.idx = 1 THEN c ELSE 0 END) / sum(c) AS score\n"
        "         FROM share JOIN lab ON share.y = lab.lvl GROUP BY f),\n"
        "mc AS (SELECT a.idx AS label, b.idx AS prediction, a.lvl AS actual, b.lvl AS predicted, score\n"
        "       FROM te JOIN best USING (f) JOIN lab a ON te.y = a.lvl JOIN lab b ON best.p = b.lvl),"
        + _weighted_sql("mc")
    )
    rows = [
        ("test", "n", "SELECT count(*)::DOUBLE FROM mc"),
        ("test", "accuracy", "SELECT count_if(label = prediction) / count(*) FROM mc"),
        *[("test", f"weighted_{m}", f"SELECT sum(actual * {c}) / sum(actual) FROM f1") for m, c in (("precision", "p"), ("recall", "r"), ("f1", "f"))],
        ("test", "rows_skipped", "SELECT 0::DOUBLE"),
    ]
    if binary:
        count = {"tp": "label = 1 AND prediction = 1", "tn": "label = 0 AND prediction = 0", "fp": "label = 0 AND prediction = 1", "fn": "label = 1 AND prediction = 0"}
        rows += [("test", m, f"SELECT count_if({c})::DOUBLE FROM mc") for m, c in count.items()]
        ctes += ",\nbin AS (SELECT " + ", ".join(f"count_if({c})::DOUBLE AS {m}" for m, c in count.items()) + " FROM mc)"
        rows += [
            ("test", "precision", "SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END FROM bin"),
            ("test", "recall", "SELECT CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END FROM bin"),
            ("test", "f1", "SELECT CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END FROM bin"),
            (
                "test", "auc",
                "SELECT sum(a.n * b.m * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) / sum(a.n * b.m) FROM "
                "(SELECT score, count(*) AS n FROM mc WHERE label = 1 GROUP BY score) a, (SELECT score, count(*) AS m FROM mc WHERE label = 0 GROUP BY score) b",
            ),
        ]
    more = (
        "UNION ALL SELECT 'test' AS split, 'n_actual_' || actual || '_predicted_' || predicted AS metric, count(*)::DOUBLE AS value FROM mc GROUP BY actual, predicted\n"
        "UNION ALL SELECT 'test' AS split, 'n_label_' || actual AS metric, count(*)::DOUBLE AS value FROM mc GROUP BY actual"
    )
    _register(f"job_{name}_exact", job, _job_sql(f"{name}_exact", ctes, rows, more=more))


_LI = [("l_orderkey", "bigint"), ("l_linenumber", "int")]
_TYPES = ["click", "view", "purchase", "signup", "error"]
_CLICK = "CASE WHEN event_type = 'click' THEN 'click' ELSE 'other' END"

_classification("iris_clf", "lineitem", _LI, "l_returnflag", ["A", "N", "R"], max_iter=10)
_classification("avocado_clf", "lineitem", _LI, "l_linestatus", ["F", "O"], binary=True)
_classification("bike_clf", "events", [("event_id", "bigint")], _CLICK, ["click", "other"], binary=True)
_classification("bike2_clf", "events", [("event_id", "bigint")], _CLICK, ["click", "other"], binary=True, where="value <= 360")
_classification("cars_clf", "part", [("p_partkey", "bigint")], "p_type", ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"], weights=(0.8, 0.2), forest=True)
_classification("medical_clf", "customer", [("c_custkey", "bigint")], "CASE WHEN c_acctbal > 6000 THEN 'yes' ELSE 'no' END", ["yes", "no"], binary=True)
_classification("youtube_clf", "customer", [("c_custkey", "bigint")], "c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], weights=(0.8, 0.2))


# --- forest regression -----------------------------------------------------------------------------------------------
def _forest_regression() -> None:
    columns = {"p_partkey": "p_partkey", "x": "CAST(p_size % 4 AS DOUBLE)", "y": "p_retailprice + 500 * (p_size % 4)"}
    params = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 5, "seed": 42}
    task = TaskSpec("cars_reg_exact", "regression", FeatureSpec(numeric=["x"]), "y", "forest", params)
    job = JobSpec("cars_reg_exact", _source("part", columns, None), ["p_partkey"], [task], weights=(0.8, 0.2))
    ctes = (
        _parts_sql("part", columns, None, [("p_partkey", "bigint")], (0.8, 0.2))
        + ",\nleaf AS (SELECT x, avg(y) AS p FROM tr GROUP BY x),\nsc AS (SELECT y, p FROM te JOIN leaf USING (x))"
    )
    e = "(y - p)"
    rows = [
        ("test", "n", "SELECT count(*)::DOUBLE FROM sc"),
        ("test", "rmse", f"SELECT sqrt(avg({e} ^ 2)) FROM sc"),
        ("test", "mse", f"SELECT avg({e} ^ 2) FROM sc"),
        ("test", "mae", f"SELECT avg(abs({e})) FROM sc"),
        ("test", "r2", f"SELECT 1 - avg({e} ^ 2) / var_pop(y) FROM sc"),
        ("test", "mape", f"SELECT avg(abs({e} / y)) * 100 FROM sc"),
        ("test", "mape_excluded", "SELECT 0::DOUBLE"),
        ("test", "rows_skipped", "SELECT 0::DOUBLE"),
    ]
    _register("job_cars_reg_exact", job, _job_sql("cars_reg_exact", ctes, rows))


_forest_regression()


# --- clustering ------------------------------------------------------------------------------------------------------
def _clustering(name: str, table: str, keys: list[tuple[str, str]], value: str, second: str, scale: str | None = None, held_out: bool = False,
                where: str | None = None, prediction: str = "prediction", max_iter: int = 20) -> None:
    key = keys[0][0]
    band = f"CASE WHEN {key} % 10 < 2 THEN 'a' WHEN {key} % 10 < 5 THEN 'b' ELSE 'c' END"
    far = f"CASE WHEN {key} % 10 < 2 THEN 0 WHEN {key} % 10 < 5 THEN 10000000 ELSE 30000000 END"
    columns = {k: k for k, _ in keys} | {
        "g": band,
        "d1": f"CAST({value} + {far} AS DOUBLE)",
        "d2": f"CAST({second} + {far if scale else '0'} AS DOUBLE)",  # scaled dimensions weigh alike, so both are banded
    }
    weights = (0.8, 0.2) if held_out else (0.7, 0.3)
    scope, split = ("train", "test") if held_out else ("all", "all")
    task = TaskSpec(
        f"{name}_exact", "clustering", FeatureSpec(numeric=["d1", "d2"], output="v", scale=scale), None, "kmeans",
        {"k": 3, "seed": 42, "maxIter": max_iter, "predictionCol": prediction}, fit_scope=scope, eval_split=split,
        profile_by="g", reports=("wssse", "cluster_means", "centers"),
    )
    job = JobSpec(f"{name}_exact", _source(table, columns, where), [k for k, _ in keys], [task], weights=weights)
    fit, ev = ("tr", "te") if held_out else ("s", "s")
    of = {None: lambda d: (d, "1.0"), "std": lambda d: (f"({d} / s{d})", f"s{d}"), "zscore": lambda d: (f"(({d} - m{d}) / s{d})", f"s{d}")}[scale]
    z1, z2 = of("d1")[0], of("d2")[0]
    ctes = (
        _parts_sql(table, columns, where, keys, weights)
        + f",\nsc AS (SELECT avg(d1) AS md1, avg(d2) AS md2, stddev_samp(d1) AS sd1, stddev_samp(d2) AS sd2 FROM {fit}),\n"
        f"fz AS (SELECT g, d1, d2, {z1} AS z1, {z2} AS z2 FROM {fit}, sc), ez AS (SELECT g, d1, d2, {z1} AS z1, {z2} AS z2 FROM {ev}, sc),\n"
        "cen AS (SELECT g, count(*) AS n, avg(z1) AS c1, avg(z2) AS c2, var_pop(z1) + var_pop(z2) AS v FROM fz GROUP BY g),\n"
        "seen AS (SELECT ez.g, count(*) AS n, avg(d1) AS a1, avg(d2) AS a2, sum((z1 - c1) ^ 2 + (z2 - c2) ^ 2) AS sse, any_value(c1) AS c1, any_value(c2) AS c2\n"
        "         FROM ez JOIN cen USING (g) GROUP BY ez.g),\n"
        "ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, g) AS r FROM seen)"
    )
    rows = [
        (split, "training_cost", "SELECT sum(n * v) FROM cen"),
        (split, "k", "SELECT 3::DOUBLE"),
        (split, "wssse", "SELECT sum(sse) FROM seen"),
        (split, "rows_skipped", "SELECT 0::DOUBLE"),
    ]
    wide = {"size_rank": ("n", ""), "mean_d1_rank": ("a1", ""), "mean_d2_rank": ("a2", ""), "center_rank": ("c1", "_dim0"), "center_rank_": ("c2", "_dim1")}
    more = "\n".join(f"UNION ALL SELECT '{split}' AS split, '{m.rstrip('_')}' || r || '{end}' AS metric, {v}::DOUBLE AS value FROM ranked" for m, (v, end) in wide.items())
    more += f"\nUNION ALL SELECT '{split}' AS split, 'n_rank' || r || '_g_' || g AS metric, n::DOUBLE AS value FROM ranked"
    _register(f"job_{name}_exact", job, _job_sql(f"{name}_exact", ctes, rows, more=more))


_clustering("iris_clu", "lineitem", _LI, "l_extendedprice", "l_quantity", max_iter=10)
_clustering("avocado_clu", "lineitem", _LI, "l_extendedprice", "l_discount", scale="std")
_clustering("bike_clu", "events", [("event_id", "bigint")], "value", "hour(ts)")
_clustering("bike2_clu", "events", [("event_id", "bigint")], "value", "hour(ts)", where="value <= 360")
_clustering("cars_clu", "part", [("p_partkey", "bigint")], "p_retailprice", "p_size", held_out=True)
_clustering("medical_clu", "customer", [("c_custkey", "bigint")], "c_acctbal", "c_nationkey")
_clustering("youtube_clu", "orders", [("o_orderkey", "bigint")], "o_totalprice", "o_custkey", scale="zscore", prediction="cluster")
