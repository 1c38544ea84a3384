"""A look inside a fitted forest: its node table, and a relational scorer that walks the table by levels.

The node table is read from the model's own Parquet form in the shared checkpoint folder, so it stays a DataFrame however
large the trees are.  The walk joins each row's place in every tree with the node table, one join a level: the planner
broadcasts the table under its own size threshold; a larger one is joined by (tree, node), where adaptive execution splits
the hot nodes near the roots.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.operators.inspect import last_stage
from tabml.session import scratch_dir

NODES = "tree node feature threshold categories left right prediction rows gain stats".split()


def forest_nodes(df: DataFrame, model) -> DataFrame:
    """One row for every node: ``tree, node, feature, threshold`` (of a numeric split, NULL otherwise), ``categories`` that
    go left (of a category split), ``left, right`` (NULL at a leaf), ``prediction, rows`` (fitted rows, copies by bagging
    included), ``gain`` and ``stats`` (class counts, or count, sum and sum of squares).  ``df`` names the session."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "forest")
    last_stage(model).write().save(path)
    n = F.col("nodeData")
    inner, numeric = n["leftChild"] >= 0, n["split"]["numCategories"] < 0
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner & numeric, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~numeric, n["split"]["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, n["leftChild"]).alias("left"),
        F.when(inner, n["rightChild"]).alias("right"),
        n["prediction"].alias("prediction"),
        n["rawCount"].alias("rows"),
        F.when(inner, n["gain"]).alias("gain"),
        n["impurityStats"].alias("stats"),
    )
    return rows.select(*NODES)


def walk(df: DataFrame, nodes: DataFrame, keys: list[str], features: str, depth: int) -> DataFrame:
    """(keys, tree, node) rows: the leaf that each row of ``df`` reaches in every tree of at most ``depth`` levels."""
    trees = nodes.filter("node = 0").agg(F.sort_array(F.collect_list("tree")).alias("_trees"))  # one row
    at = df.select(*keys, vector_to_array(F.col(features)).alias("_x")).crossJoin(F.broadcast(trees))
    at = at.select(*keys, "_x", F.explode("_trees").alias("tree"), F.lit(0).alias("node"))
    splits = nodes.filter("left IS NOT NULL").select("tree", "node", "feature", "threshold", "categories", "left", "right")
    for _ in range(depth):
        value = F.get("_x", F.col("feature"))
        goes_left = F.coalesce(value <= F.col("threshold"), F.array_contains("categories", value))
        step = F.when(F.col("left").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(splits, ["tree", "node"], "left").select(*keys, "_x", "tree", step.alias("node"))
    return at.drop("_x")


def walked_scores(df: DataFrame, model, keys: list[str], nodes: DataFrame | None = None) -> DataFrame:
    """(keys, prediction, probability) by the node table alone: the mean of the leaves' predictions, or for classes the
    mean of the leaves' shares and the first largest (probability NULL for a regression).  Keys name rows; rows of equal
    keys are scored as one."""
    m = last_stage(model)
    nodes = forest_nodes(df, model) if nodes is None else nodes
    reached = walk(df, nodes, keys, m.getFeaturesCol(), max(t.depth for t in m.trees))
    leaves = nodes.filter("left IS NULL").select("tree", "node", "prediction", "stats")
    leaves = reached.join(leaves, ["tree", "node"])
    if not isinstance(m, RandomForestClassificationModel):
        return leaves.groupBy(*keys).agg(F.avg("prediction").alias("prediction")).withColumn("probability", F.lit(None).cast("array<double>"))
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    share = lambda k: F.avg(F.get("stats", F.lit(k)) / total)
    votes = leaves.groupBy(*keys).agg(F.array(*[share(k) for k in range(m.numClasses)]).alias("probability"))
    return votes.select(*keys, (F.array_position("probability", F.array_max("probability")) - 1).cast("double").alias("prediction"), "probability")


def walk_check(scored: DataFrame, model, keys: list[str], prediction: str = "prediction") -> DataFrame:
    """One row: rows, trees, rows whose walked prediction differs from the model's, and fewest and most rows a tree holds.

    Numbers are compared to 9 digits, as sums over trees round in their own order; classes exactly unless the two best
    shares are that close."""
    nodes = forest_nodes(scored, model)
    walked = walked_scores(scored, model, keys, nodes).withColumnRenamed("prediction", "_walked")
    close: Column = F.abs(F.col(prediction) - F.col("_walked")) <= 1e-9 * F.greatest(F.abs(F.col(prediction)), F.lit(1.0))
    best = F.sort_array("probability", asc=False)
    tied = F.coalesce(F.get(best, F.lit(0)) - F.get(best, F.lit(1)) < 1e-9, F.lit(False))
    both = scored.select(*keys, prediction).join(walked, keys, "left")
    m = last_stage(model)
    rows = both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(close | tied, F.lit(False))).alias("walk_differs"))
    per_tree = walk(scored, nodes, keys, m.getFeaturesCol(), max(t.depth for t in m.trees)).groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    return rows.crossJoin(per_tree.agg(F.count(F.lit(1)).alias("trees"), F.min("n").alias("fewest_in_tree"), F.max("n").alias("most_in_tree")))
