import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabml.operators.features import FeatureSpec, feature_stages
from tabml.operators.forest import NODES, forest_nodes, walk, walk_check, walked_scores
from tabml.operators.inspect import last_stage
from tabml.operators import models as M
from tabml.operators.models import fit_on, kmeans, random_forest_classifier, random_forest_regressor


def _table(spark, n=400):
    rows = [(i, float(i % 17), f"c{i * 7 % 5}", float((i % 17) * 3 + i * 7 % 5), float(i % 17 > 8 or i * 7 % 5 == 2)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, x double, c string, y double, label double").repartition(3)


def _fitted(df, classes):
    rf = random_forest_classifier(num_trees=4) if classes else random_forest_regressor(label="y", num_trees=4)
    return fit_on(Pipeline(stages=feature_stages(FeatureSpec(numeric=["x"], one_hot=["c"])) + [rf]), df)


def _descend(nodes, x):
    """The leaf of one tree for one row, by the plain rules."""
    at = 0
    while nodes[at].left is not None:
        n = nodes[at]
        v = x[n.feature]
        at = n.left if (v <= n.threshold if n.threshold is not None else v in n.categories) else n.right
    return at


@pytest.mark.parametrize("classes", [False, True])
def test_walk_follows_every_split_and_scores_as_the_model(spark, classes):
    df = _table(spark)
    model = _fitted(df, classes)
    scored, nodes = model.transform(df), forest_nodes(df, model)
    assert nodes.columns == NODES
    by_tree = {}
    for r in nodes.collect():
        by_tree.setdefault(r.tree, {})[r.node] = r
    assert len(by_tree) == 4 and any(n.categories for t in by_tree.values() for n in t.values())
    depth = max(t.depth for t in last_stage(model).trees)
    got = {(r.id, r.tree): r.node for r in walk(scored, nodes, ["id"], "features", depth).collect()}
    for r in scored.select("id", vector_to_array("features").alias("x")).collect():
        for t, tree in by_tree.items():
            assert got[r.id, t] == _descend(tree, r.x)
    walked = {r.id: (r.prediction, r.probability) for r in walked_scores(scored, model, ["id"]).collect()}
    shown = scored.select("id", "prediction", vector_to_array("probability").alias("p") if classes else F.lit(None).alias("p"))
    for r in shown.collect():
        assert walked[r.id][0] == pytest.approx(r.prediction)
        assert not classes or walked[r.id][1] == pytest.approx(r.p)


def test_leaf_rows_add_up_and_the_check_sees_a_wrong_prediction(spark):
    df = _table(spark)
    model = _fitted(df, False)
    nodes = forest_nodes(df, model)
    leaves = nodes.filter("left IS NULL").groupBy("tree").agg(F.sum("rows").alias("n")).collect()
    roots = {r.tree: r["rows"] for r in nodes.filter("node = 0").collect()}
    assert {r.tree: r.n for r in leaves} == roots
    scored = model.transform(df)
    ok = walk_check(scored, model, ["id"]).first()
    assert ok.asDict() == {"rows": 400, "walk_differs": 0, "trees": 4, "fewest_in_tree": 400, "most_in_tree": 400}
    bad = scored.withColumn("prediction", F.when(F.col("id") < 7, 1e6).otherwise(F.col("prediction")))
    assert walk_check(bad, model, ["id"]).first().walk_differs == 7


def test_a_walk_of_no_rows(spark):
    df = _table(spark)
    model = _fitted(df, False)
    assert walked_scores(model.transform(df.limit(0)), model, ["id"]).count() == 0
    assert walk_check(model.transform(df.limit(0)), model, ["id"]).first()["rows"] == 0


def test_one_join_a_level_and_no_shuffle_below_the_threshold(spark):
    df = _table(spark)
    model = _fitted(df, False)
    scored, nodes = model.transform(df), forest_nodes(df, model)
    plan = walk(scored, nodes, ["id"], "features", 3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Python" not in plan


@pytest.mark.parametrize("kind", ["forest", "pipeline", "kmeans"])
def test_a_fit_holds_few_rows_a_task(spark, kind, monkeypatch):
    """One large partition, many equal rows among them: each task of the fit gets at most its share, and no row is lost."""
    df = _table(spark).union(_table(spark).filter("id = 0").crossJoin(spark.range(200)).drop("id").selectExpr("0 as id", "x", "c", "y", "label")).coalesce(1)
    stages = feature_stages(FeatureSpec(numeric=["x"], one_hot=["c"]))
    x = Pipeline(stages=stages).fit(df).transform(df)
    est = kmeans() if kind == "kmeans" else random_forest_regressor(label="y", num_trees=4)
    seen = []
    for cls in {type(est)}:
        fit = cls._fit
        monkeypatch.setattr(cls, "_fit", lambda self, data, fit=fit: (seen.append(data), fit(self, data))[1])
    wanted = sorted(r[0].toArray().tolist() for r in x.select("features").collect())
    fit_on(Pipeline(stages=[*stages, est]) if kind == "pipeline" else est, df if kind == "pipeline" else x)
    assert seen.pop().rdd.getNumPartitions() == 1  # small enough: as it is
    monkeypatch.setattr(M, "FIT_BYTES", 50 * M.held_bytes(est, 5))
    model = fit_on(Pipeline(stages=[*stages, est]) if kind == "pipeline" else est, df if kind == "pipeline" else x)
    parts = seen.pop().select("features").rdd.glom().collect()
    assert len(parts) == 12 and max(map(len, parts)) <= 55
    assert sorted(r[0].toArray().tolist() for p in parts for r in p) == wanted
    assert model.transform(df if kind == "pipeline" else x).count() == 600
