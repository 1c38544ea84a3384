"""The free-form analyses on their own inputs, held to what must be true of any correct fit.

Every classification, clustering and forest task of the analyses runs as it is, with the ``fit_check`` report; the rows kept
here have one right value whatever the fit found: a fixed point has no residual, every row is at its nearest centre, the
clusters' moments add up to the rows' sum of squares, a forest's node table scores as the model does, and counts are counts.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.features import assembler, feature_stages
from tabml.operators.forest import forest_nodes, walk, walked_scores
from tabml.operators.inspect import last_stage
from tabml.operators.models import fit_on, random_forest_classifier, random_forest_regressor
from tabml.plans.catalog import query
from tabml.plans.job_queries import _CHANNEL_SQL, DIGITS, _events_parts, _job_sql, task_job
from tabml.plans.jobs import RESULT, run_job
from tabml.plans.model_queries import _STUMP_SQL, _part_features
from tabml.plans.sqlgen import EDGE_70, EDGE_80, hashed_sql, unit_sql
from tabml.sources import load_table

#: Metrics with one right value; sizes of clusters are added up.
FIXED = "n rows_skipped rows_trimmed k off_nearest residual total_ss rows walk_differs trees fewest_in_tree most_in_tree".split()


def _register(task: str, sql: str, but: tuple[str, ...] = ()) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        job = task_job(task)
        job = replace(job, tasks=[replace(t, reports=(*t.reports, "fit_check")) for t in job.tasks])
        found = run_job(spark, job, sf_dir, digits=DIGITS)
        sizes = found.filter(F.col("metric").startswith("size_rank")).groupBy("job", "task", "split").agg(F.sum("value").alias("value"))
        fixed = found.filter(F.col("metric").isin([m for m in FIXED if m not in but]))
        columns = [c.split()[0] for c in RESULT.split(", ")]
        return fixed.unionByName(sizes.withColumn("metric", F.lit("size_total")).select(*columns))

    run.__name__ = f"job_{task}_checked"
    run.__doc__ = f"Task {task} on its own input: the rows that any correct fit must report (see the module)."
    query(f"job_{task}_checked", sql=sql, kind="S")(run)


def _split(source: str, keys: list[tuple[str, str]], edge: str) -> str:
    return f"s AS (SELECT *, {unit_sql('_h')} AS u FROM {hashed_sql(source, keys)}), tr AS (SELECT * FROM s WHERE u < {edge}), te AS (SELECT * FROM s WHERE u >= {edge})"


_ZERO = "SELECT 0::DOUBLE"
_LINES = _split("lineitem", [("l_orderkey", "bigint"), ("l_linenumber", "int")], EDGE_70)
_PARTS = _split("(SELECT * FROM part WHERE p_partkey IS NOT NULL AND p_name IS NOT NULL AND p_brand IS NOT NULL AND p_type IS NOT NULL AND p_size IS NOT NULL AND p_retailprice IS NOT NULL)", [("p_partkey", "bigint")], EDGE_80)
_PEOPLE = _split("customer", [("c_custkey", "bigint")], EDGE_70)
_CHANNELS = _split(_CHANNEL_SQL, [("c_custkey", "bigint")], EDGE_80)
_TRIPS = {"bike": _events_parts().rstrip(",\n"), "bike2": _events_parts("AND duration_sec <= 3600").rstrip(",\n")}


def _logistic(job: str, ctes: str, test: str = "SELECT count(*)::DOUBLE FROM te") -> None:
    rows = [("test", "n", test), ("test", "rows_skipped", _ZERO), ("train", "residual", _ZERO)]
    _register(f"{job}_clf", _job_sql(job, ctes, rows, task=f"{job}_clf"))


_logistic("iris", _LINES)
_logistic("avocado", _LINES)
_logistic("bike", _TRIPS["bike"])
_logistic("bike2", _TRIPS["bike2"])
_logistic("medical", _PEOPLE)
_TOP5 = "SELECT country FROM s GROUP BY country ORDER BY count(*) DESC, country LIMIT 5"
_logistic("youtube", _CHANNELS, f"SELECT count(*)::DOUBLE FROM te WHERE country IN ({_TOP5})")


def _forest(task: str, known: str, more: list[tuple[str, str, str]]) -> None:
    """Rows with a category that the train part has not are skipped."""
    n = f"SELECT count(*)::DOUBLE FROM te WHERE {known}"
    rows = [("test", m, n) for m in ("n", "rows", "fewest_in_tree", "most_in_tree")]
    rows += [("test", "rows_skipped", f"SELECT count(*)::DOUBLE FROM te WHERE NOT ({known})"), ("test", "walk_differs", _ZERO), ("test", "trees", "SELECT 10::DOUBLE")]
    _register(task, _job_sql("cars", _PARTS, rows + more, task=task))


_SEEN = "p_brand IN (SELECT p_brand FROM tr) AND p_type IN (SELECT p_type FROM tr)"
_forest("cars_reg", _SEEN, [])
_forest("cars_clf", _SEEN, [])


def _clusters(job: str, ctes: str, k: int, total_ss: str | None, part: str = "all", rows_of: str = "s", more: list | None = None) -> None:
    fit = "train" if part == "test" else part
    rows = [
        (part, "k", f"SELECT {k}::DOUBLE"),
        (part, "rows_skipped", _ZERO),
        (part, "size_total", f"SELECT count(*)::DOUBLE FROM {rows_of}"),
        (fit, "off_nearest", _ZERO),
        (fit, "residual", _ZERO),
    ]
    rows += [(fit, "total_ss", total_ss)] if total_ss else []
    _register(f"{job}_clu", _job_sql(job, ctes, rows + (more or []), task=f"{job}_clu"), () if total_ss else ("total_ss", "rows_skipped"))


def _sum_of_squares(*columns: str) -> str:
    return f"SELECT {' + '.join(f'var_pop({c}) * count(*)' for c in columns)} FROM s"


def _scaled(rows: str, *columns: str) -> str:
    """Scaled to unit sample variance, a column's squares add up to rows - 1."""
    return f"SELECT {' + '.join(f'CASE WHEN var_pop({c}) > 0 THEN count(*) - 1 ELSE 0 END' for c in columns)}::DOUBLE FROM {rows}"


_TRIP = ("x1", "duration_sec", "x2", "x3")
_TRIM = "(SELECT *, views / subscribers AS v FROM s WHERE subscribers > 1000 AND subscribers < 1e8 AND views < 1e10)"
_clusters("iris", _LINES, 3, _sum_of_squares("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
_clusters("avocado", _LINES, 3, _scaled("(SELECT *, year(l_shipdate) AS y FROM s)", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "y"))
_clusters("bike", _TRIPS["bike"], 5, _sum_of_squares(*_TRIP))
_clusters("bike2", _TRIPS["bike2"], 5, _sum_of_squares(*_TRIP))
_clusters("medical", _PEOPLE, 3, _sum_of_squares("c_acctbal", "c_nationkey", "c_custkey % 7"))
_clusters(
    "youtube", _CHANNELS + ",\nreal AS (SELECT * FROM s WHERE views / subscribers > 0)", 4,
    _scaled(_TRIM.replace("FROM s", "FROM real"), "subscribers", "views", "v"), rows_of=_TRIM.replace("FROM s", "FROM real"),
    more=[("all", "rows_trimmed", "SELECT count_if(NOT (subscribers > 1000 AND subscribers < 1e8 AND views < 1e10))::DOUBLE FROM real")],
)


def _cars_total() -> str:
    """Sum of squares of the size and of the one-hot levels of the train part (all but the rarest, as indexed)."""
    levels = " + ".join(
        f"(SELECT sum(c * (1 - c / n)) FROM (SELECT count(*)::DOUBLE AS c, (SELECT count(*) FROM tr) AS n, row_number() OVER (ORDER BY count(*), {c} DESC) AS last FROM tr GROUP BY {c}) WHERE last > 1)"
        for c in ("p_brand", "p_type")
    )
    return f"SELECT (SELECT var_pop(p_size) * count(*) FROM tr) + {levels}"


_clusters("cars", _PARTS, 3, _cars_total(), part="test", rows_of=f"(SELECT * FROM te WHERE {_SEEN})")


# --- J05 / J06: inside a forest ---------------------------------------------------------------------------------------
@query(
    "rf_node_walk",
    kind="S",
    sql="SELECT p_partkey, task, true AS same_prediction FROM part, (VALUES ('regression'), ('classification')) t(task)",
)
def rf_node_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10-tree forests of the car analysis: every row scored from the node table alone, against the model."""
    part = load_table(spark, sf_dir, "part")
    label = [feature_stages(_part_features())[0].copy()]  # indexes brand and type; the type's index is the class
    pipes = {
        "regression": feature_stages(_part_features()) + [random_forest_regressor(label="p_retailprice")],
        "classification": label + [assembler(["p_size", "p_retailprice", "p_brand_index"]), random_forest_classifier(label="p_type_index")],
    }
    out = None
    for task, stages in pipes.items():
        model = fit_on(Pipeline(stages=stages), part)
        scored = model.transform(part)
        walked = walked_scores(scored, model, ["p_partkey"]).withColumnRenamed("prediction", "walked")
        same = F.abs(F.col("prediction") - F.col("walked")) <= 1e-9 * F.greatest(F.abs("prediction"), F.lit(1.0))
        rows = scored.select("p_partkey", "prediction").join(walked, "p_partkey").select("p_partkey", F.lit(task).alias("task"), same.alias("same_prediction"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "rf_node_table",
    kind="C",
    sql=f"""
WITH stump AS ({_STUMP_SQL}),
side AS (SELECT *, unnest([0, 1, 2]) AS node FROM stump)
SELECT 0 AS tree, node, CASE WHEN node = 0 THEN 0 END AS feature, CASE WHEN node = 0 THEN threshold END AS threshold,
       CASE WHEN node = 0 THEN 1 END AS "left", CASE WHEN node = 0 THEN 2 END AS "right",
       round(CASE node WHEN 0 THEN (n_left * left_mean + n_right * right_mean) / (n_left + n_right) WHEN 1 THEN left_mean ELSE right_mean END, 2) AS prediction,
       CASE node WHEN 0 THEN n_left + n_right WHEN 1 THEN n_left ELSE n_right END AS rows
FROM side
""",
)
def rf_node_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node table of the unbagged stump of ``rf_stump_regress``: split, children, means and rows."""
    part = load_table(spark, sf_dir, "part").select(F.col("p_size").cast("double").alias("x"), "p_retailprice")
    rf = random_forest_regressor(label="p_retailprice", num_trees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", maxBins=64)
    nodes = forest_nodes(part, fit_on(Pipeline(stages=[assembler(["x"]), rf]), part))
    return nodes.select("tree", "node", "feature", "threshold", "left", "right", F.round("prediction", 2).alias("prediction"), "rows")


@query("rf_leaf_rows", kind="S", sql="SELECT 0 AS tree, count(*) AS rows, 0::BIGINT AS leaves_differ FROM part")
def rf_leaf_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unbagged tree: the rows that the walk brings to a leaf are the rows the leaf was fitted on."""
    part = load_table(spark, sf_dir, "part")
    rf = random_forest_regressor(label="p_retailprice", num_trees=1, bootstrap=False, featureSubsetStrategy="all")
    model = fit_on(Pipeline(stages=feature_stages(_part_features()) + [rf]), part)
    scored, nodes = model.transform(part), forest_nodes(part, model)
    reached = walk(scored, nodes, ["p_partkey"], "features", max(t.depth for t in last_stage(model).trees)).groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"))
    both = nodes.filter("left IS NULL").select("tree", "node", "rows").join(reached, ["tree", "node"], "full")
    return both.groupBy("tree").agg(F.sum("n").alias("rows"), F.count_if(~F.col("rows").eqNullSafe(F.col("n"))).alias("leaves_differ"))
