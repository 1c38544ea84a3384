"""A key holding a third of all rows: results stay exact and aggregations fold it map-side."""

from pyspark.sql import functions as F

from tabml.operators import evaluate as K
from tabml.operators import relational as R
from tabml.operators.split import hash_split


def _skewed(spark, n=30000):
    # one key (0) holds a third of the rows, the rest are spread over ~n/3 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % (n // 3) + 1).alias("k"),
        (F.col("id") % 7).cast("double").alias("label"),
        (F.col("id") % 5).cast("double").alias("prediction"),
    )


def test_group_count_and_top_k_exact_under_a_hot_key(spark):
    df = _skewed(spark)
    top = R.top_k_groups(df, "k", 1).first()
    assert top.k == 0 and top["count"] == 10000
    semi = R.top_k_semi_filter(df, "k", 1)
    assert semi.count() == 10000
    plan = R.group_count(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # map-side combine before the shuffle


def test_metrics_exact_under_a_hot_key(spark):
    df = _skewed(spark)
    conf = {(r.label, r.prediction): r["count"] for r in K.confusion(df, "label", "prediction").collect()}
    assert sum(conf.values()) == 30000
    acc = K.classification_metrics(df, "label", "prediction").first().accuracy
    assert abs(acc - sum(v for (a, b), v in conf.items() if a == b) / 30000) < 1e-12


def test_hash_split_of_a_hot_key_keeps_the_group_whole(spark):
    df = _skewed(spark)
    train, test = hash_split(df, ["k"], (0.7, 0.3))
    hot_train = train.filter("k = 0").count()
    assert hot_train in (0, 10000)  # a key's rows never straddle the parts
    assert train.count() + test.count() == 30000


def test_cluster_profile_with_a_hot_cluster(spark):
    from tabml.operators.features import assembler

    df = assembler(["label"], "features").transform(
        _skewed(spark).withColumn("cluster", F.when(F.col("k") == 0, 0).otherwise(1))
    )
    centers = [[0.0], [3.0]]
    prof = {r.cluster: r for r in K.cluster_profile(df, "features", "cluster", centers, ["label"]).collect()}
    assert prof[0]["size"] == 10000 and prof[0]["size"] + prof[1]["size"] == 30000
