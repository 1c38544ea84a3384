import math
import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tabml.operators.evaluate import roc_area
from tabml.operators.features import index_by_table, level_table
from tabml.operators.ranking import ACCURACY, global_rank, heavy_groups, large_limit
from tabml.operators.split import covers, fingerprint, hash_split


def _sort_key(v):
    return (v is not None, v is not None and isinstance(v, float) and math.isnan(v), v if v is not None and v == v else 0)


def _first(rows, n):
    return sorted(rows, key=lambda r: [_sort_key(v) for v in r])[:n]


def _values(rng, n):
    return [(None if rng.random() < 0.05 else float("nan") if rng.random() < 0.05 else 5.0 if rng.random() < 0.4 else round(rng.uniform(0, 10), 1), rng.choice([None, 1, 1, 2, 3]), i) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 30, 150, 400, 900, 999, 1000, 5000])
def test_large_limit_equals_the_plain_one(spark, n):
    rows = _values(random.Random(n), 1000)
    df = spark.createDataFrame(rows, "a double, b int, c int").repartition(7)
    got = [tuple(r) for r in large_limit(df, ["a", "b", "c"], n).collect()]
    assert repr(sorted(got, key=lambda r: r[2])) == repr(sorted(_first(rows, n), key=lambda r: r[2]))


def test_large_limit_of_equal_rows_text_and_empty(spark):
    same = spark.createDataFrame([(1.0,)] * 50, "a double")
    assert large_limit(same, ["a"], 20).count() == 20
    words = spark.createDataFrame([(w,) for w in "d b a c".split()], "w string")
    assert [r.w for r in large_limit(words, ["w"], 2).orderBy("w").collect()] == ["a", "b"]
    assert large_limit(same.limit(0), ["a"], 5).count() == 0


def test_large_limit_sorts_about_n_rows(spark):
    df = spark.range(0, 200_000, 1, 40).select((F.col("id") * 7919 % 200_003).cast("double").alias("a"), "id")
    n = 20_000
    cut = large_limit(df, ["a", "id"], n)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalLimit" in plan or "GlobalLimit" in plan
    kept = df.filter(F.col("a") <= cut.agg(F.max("a")).first()[0] + 200_000 * 4 / ACCURACY).count()
    assert cut.count() == n and kept < n * 1.1


def test_global_rank_is_dense_and_ordered(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.choice("aaaab"), i) for i in range(500)], "k string, i int").repartition(6)
    got = sorted((r["rank"], r.k, r.i) for r in global_rank(df, ["k", "i"]).collect())
    assert [g[0] for g in got] == list(range(500)) and [g[1:] for g in got] == sorted((r.k, r.i) for r in df.collect())
    assert global_rank(df.limit(0), ["k", "i"]).count() == 0


@pytest.mark.parametrize("tracked, hot", [(1024, True), (8, True), (8, False)])
def test_heavy_groups_are_exact_whether_proven_or_not(spark, tracked, hot):
    rng = random.Random(5)
    values = [rng.choice(["hot", "hot", "warm", None]) if hot and rng.random() < 0.9 else f"v{rng.randrange(700)}" for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    for k in (1, 3, 5):
        top, proven = heavy_groups(df, "v", k, tracked)
        want = sorted(Counter(values).items(), key=lambda t: (-t[1], t[0] is not None, t[0] or ""))[:k]
        assert [(r.v, r["count"]) for r in top.orderBy(F.desc("count"), "v").collect()] == want
    assert heavy_groups(df, "v", 1, 16_384)[1] == hot or not hot
    assert heavy_groups(df.limit(0), "v", 3)[0].count() == 0


@pytest.mark.parametrize("mode", ["error", "skip", "keep"])
def test_index_by_table_matches_the_indexer(spark, mode):
    rng = random.Random(7)
    df = spark.createDataFrame([(i, rng.choice(["x", "y", "z", "ü", "w", "w"])) for i in range(200)], "i int, `c.d` string")
    levels = level_table(df, "c.d")
    want = StringIndexer(inputCol="v", outputCol="v_index", handleInvalid=mode).fit(df.toDF("i", "v")).transform(df.toDF("i", "v"))
    got = index_by_table(df, "c.d", levels, mode)
    assert {r.i: r["c.d_index"] for r in got.collect()} == {r.i: r.v_index for r in want.collect()}
    more = spark.createDataFrame([(1, "x"), (2, "new"), (3, None)], "i int, `c.d` string")
    if mode == "error":
        with pytest.raises(Exception, match="unseen or NULL level"):
            index_by_table(more, "c.d", levels, mode).collect()
    else:
        found = {r.i: r["c.d_index"] for r in index_by_table(more, "c.d", levels, mode).collect()}
        assert set(found) == ({1} if mode == "skip" else {1, 2, 3}) and (mode == "skip" or found[2] == found[3] == 5.0)


def test_levels_stay_off_the_driver(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("v"))
    plan = index_by_table(df, "v", level_table(df, "v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "n4999" not in plan


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_roc_area_matches_the_evaluator(spark, ranges):
    rng = random.Random(ranges)
    rows = [(float(rng.random() < 0.3), 0.5 if rng.random() < 0.4 else round(rng.random(), 2)) for _ in range(800)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(5)
    got = roc_area(df, "label", "score", ranges).first()
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert got.auc == pytest.approx(ev.evaluate(df), abs=1e-12) and got.n_pos + got.n_neg == 800
    plan = roc_area(df, "label", "score", ranges)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapPartitions" not in plan


def test_roc_area_of_one_label_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, None), (1.0, 0.4)], "label double, score double")
    assert roc_area(df, "label", "score").first().auc == 1.0 and roc_area(df, "label", "score").first().n_pos == 2
    assert roc_area(df.selectExpr("0.0 AS label", "score"), "label", "score").first().auc == 0.0
    assert roc_area(df.limit(0), "label", "score").first().auc in (None, 0.0)


def test_a_cover_sees_lost_doubled_and_swapped_rows(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}" if i % 4 else None) for i in range(100)], "id int, t string")
    a, b = hash_split(df, ["id"], (0.6, 0.4))
    assert covers([a, b], df.repartition(9)).first().covered
    assert not covers([a, b.limit(b.count() - 1)], df).first().covered
    assert not covers([a, b, b.limit(1)], df).first().covered
    assert not covers([a, b.withColumn("t", F.lit("x"))], df).first().covered
    assert covers([a, b.withColumn("t", F.lit("x"))], df, ["id"]).first().covered
    none = fingerprint(df.limit(0)).first()
    assert none["rows"] == 0 and none.xors == [0, 0]
