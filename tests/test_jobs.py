import pytest

from tabml.plans.job_queries import JOBS, JOB_BY_NAME, task_job
from tabml.plans.jobs import run_job
from tests.conftest import SF_SMALL


def _metrics(df):
    return {(r.split, r.metric): r.value for r in df.collect()}


def test_twenty_tasks():
    assert sum(len(j.tasks) for j in JOBS) == 20


def test_shared_job_runs_all_tasks_with_bounded_metrics(spark):
    out = run_job(spark, JOB_BY_NAME["cars"], SF_SMALL)
    rows = out.collect()
    assert {r.task for r in rows} == {"cars_reg", "cars_clf", "cars_clu"}
    m = {(r.task, r.metric): r.value for r in rows}
    assert 0.0 <= m[("cars_clf", "accuracy")] <= 1.0
    assert m[("cars_reg", "rmse")] >= 0.0 and m[("cars_reg", "r2")] <= 1.0
    assert -1.0 <= m[("cars_clu", "silhouette")] <= 1.0


def test_binary_job_reports_confusion_and_auc(spark):
    m = _metrics(run_job(spark, task_job("medical_clf"), SF_SMALL))
    tp, tn, fp, fn = (m[("test", k)] for k in ("tp", "tn", "fp", "fn"))
    assert tp + tn + fp + fn == m[("test", "n")]
    assert 0.0 <= m[("test", "auc")] <= 1.0


def test_clustering_sizes_cover_all_rows(spark):
    job = task_job("bike_clu")
    m = _metrics(run_job(spark, job, SF_SMALL))
    n = job.source(spark, SF_SMALL).count()
    assert sum(v for (s, k), v in m.items() if k.startswith("size_rank")) == n


def test_kmeans_points_at_nearest_centre(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from tabml.operators.features import assembler
    from tabml.operators.models import kmeans

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_quantity", "l_discount")
    model = Pipeline(stages=[assembler(li.columns), kmeans(k=3, seed=42, max_iter=10)]).fit(li)
    centers = [c.tolist() for c in model.stages[-1].clusterCenters()]
    for r in model.transform(li).select(vector_to_array("features").alias("x"), "prediction").collect():
        d = [sum((a - b) ** 2 for a, b in zip(r.x, c)) for c in centers]
        assert d[r.prediction] == pytest.approx(min(d))


def test_regression_job_reports_coefficients_and_bands(spark):
    m = _metrics(run_job(spark, task_job("bike2_reg"), SF_SMALL))
    assert ("train", "intercept") in m and ("train", "coef_hour") in m
    sample = {k: v for (_, k), v in m.items() if k.startswith("sample_")}
    assert len(sample) == 30
    for k, v in sample.items():
        if k.endswith("_abs_error"):
            stem = k.removesuffix("_abs_error")
            assert v == pytest.approx(abs(sample[f"{stem}_actual"] - sample[f"{stem}_predicted"]))
    bands = [k for (_, k) in m if k.startswith("n_band_")]
    assert sum(m[("test", k)] for k in bands) == m[("test", "n")]


def test_runner_refuses_target_as_feature(spark):
    from dataclasses import replace

    from tabml.operators.features import FeatureSpec
    from tabml.plans.jobs import TaskSpec

    job = task_job("avocado_reg")
    bad = TaskSpec("bad", "regression", FeatureSpec(numeric=["l_quantity", "l_extendedprice"]), "l_extendedprice")
    with pytest.raises(ValueError):
        run_job(spark, replace(job, tasks=[bad]), SF_SMALL)


def test_fit_scope_all_evaluates_every_row(spark):
    job = task_job("iris_clu")
    m = _metrics(run_job(spark, job, SF_SMALL))
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert sum(v for (s, k), v in m.items() if k.startswith("size_rank")) == n
    assert all(s == "all" for (s, _) in m)


def test_metrics_sink_round_trip(spark, tmp_path):
    out = str(tmp_path / "metrics")
    res = run_job(spark, task_job("youtube_reg"), SF_SMALL, sink=out)
    back = spark.read.parquet(out)
    assert back.count() == res.count()
    assert {r.job for r in back.select("job").distinct().collect()} == {"youtube"}


def test_skip_rows_are_counted(spark):
    m = _metrics(run_job(spark, task_job("cars_clf"), SF_SMALL))
    assert m[("test", "rows_skipped")] >= 0


ALL_TASKS = [t.name for j in JOBS for t in j.tasks]


@pytest.mark.parametrize("task", ALL_TASKS)
def test_every_task_reports_sane_metrics(spark, task):
    m = {}
    for r in run_job(spark, task_job(task), SF_SMALL, digits=6).collect():
        assert r.job and r.task == task and r.split in {"train", "test", "all"}
        m[(r.split, r.metric)] = r.value
    assert m, "no metric rows"
    for (split, name), v in m.items():
        if v is None:
            continue
        if name in {"accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "precision", "recall", "f1",
                    "auc"}:
            assert 0.0 <= v <= 1.0, (name, v)
        if name in {"rmse", "mse", "mae", "mape", "training_cost", "wssse"} or name.startswith(("n", "size_rank")):
            assert v >= 0.0, (name, v)
        if name == "r2":
            assert v <= 1.0
        if name == "silhouette":
            assert -1.0 <= v <= 1.0
    if ("test", "tp") in m:
        assert sum(m[("test", k)] for k in ("tp", "tn", "fp", "fn")) == m[("test", "n")]
    sizes = [v for (_, k), v in m.items() if k.startswith("size_rank")]
    assert sizes == sorted(sizes, reverse=True)


def test_checkpointed_source_gives_same_metrics(spark):
    from dataclasses import replace

    job = JOB_BY_NAME["medical"]
    a = _metrics(run_job(spark, job, SF_SMALL, digits=6))
    b = _metrics(run_job(spark, replace(job, materialize="checkpoint"), SF_SMALL, digits=6))
    reg = {k: v for k, v in a.items() if k[1] in ("rmse", "r2", "mae", "n")}
    assert reg and all(b[k] == v for k, v in reg.items())


def test_feature_scope_all_and_cluster_class_profile(spark):
    from dataclasses import replace

    job = task_job("iris_clf")
    t = replace(job.tasks[0], feature_scope="all")
    m = _metrics(run_job(spark, replace(job, tasks=[t]), SF_SMALL))
    assert 0.0 <= m[("test", "accuracy")] <= 1.0
    prof = {k: v for (_, k), v in _metrics(run_job(spark, task_job("iris_clu"), SF_SMALL)).items()
            if k.startswith("n_rank")}
    assert prof and sum(prof.values()) == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_whole_job_reports_source_profile_and_split_sizes(spark):
    rows = run_job(spark, JOB_BY_NAME["iris"], SF_SMALL, digits=6).collect()
    src = {r.metric: r.value for r in rows if r.task == "source"}
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert src["rows_train"] + src["rows_test"] == n
    prof = {r.metric: r.value for r in run_job(spark, JOB_BY_NAME["bike"], SF_SMALL).collect() if r.task == "source"}
    assert prof["min_hour"] >= 0 and prof["max_hour"] <= 23 and prof["count_duration_sec"] > 0


def test_config_defined_job_equals_code_defined(spark):
    from tabml.plans.config import job_from_dict

    cfg = {
        "name": "orders_reg",
        "source": {
            "table": "orders",
            "derive": {"o_custkey": "CAST(o_custkey AS DOUBLE)", "month": "month(o_orderdate)",
                       "day_of_week": "dayofweek(o_orderdate)"},
            "select": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "month", "day_of_week"],
        },
        "keys": ["o_orderkey"],
        "tasks": [{
            "name": "orders_reg", "kind": "regression", "target": "o_totalprice", "estimator": "linear",
            "features": {"numeric": ["o_custkey", "month", "day_of_week"], "output": "reg_features"},
            "params": {"maxIter": 10}, "reports": ["coefficients", "label_stats", "banded"],
            "band_col": "month", "band_bounds": [4, 7, 10],
        }],
    }
    a = _metrics(run_job(spark, job_from_dict(cfg), SF_SMALL, digits=6))
    b = _metrics(run_job(spark, task_job("orders_reg"), SF_SMALL, digits=6))
    assert a == b
    for bad in ({"sauce": 1}, {"tasks": [cfg["tasks"][0] | {"band_cols": "month"}]}, {"tasks": [cfg["tasks"][0] | {"reports": ["coeficients"]}]},
                {"tasks": [cfg["tasks"][0] | {"features": {"numerics": []}}]}):
        with pytest.raises(ValueError, match="unknown"):
            job_from_dict(cfg | bad)


def test_random_split_mode_runs_and_partitions(spark):
    from dataclasses import replace

    job = replace(task_job("price_reg"), split_mode="random")
    with pytest.raises(ValueError, match="checkpoint"):
        run_job(spark, job, SF_SMALL)
    m = _metrics(run_job(spark, replace(job, materialize="checkpoint"), SF_SMALL))
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert 0 < m[("test", "n")] < n
    assert m[("train", "rmse")] >= 0.0


def test_logistic_coefficient_report(spark):
    m = _metrics(run_job(spark, task_job("youtube_clf"), SF_SMALL))
    coefs = [k for (s, k) in m if s == "train" and k.startswith("coef_")]
    # 5 classes × (3 features + intercept), by class name
    assert len(coefs) == 5 * 4 and all(m[("train", k)] == m[("train", k)] for k in coefs)
    assert len({k.split("_")[1] for k in coefs}) == 5
    table = {k: v for (_, k), v in m.items() if k.startswith("n_actual_")}
    assert sum(table.values()) == m[("test", "n")]


def test_rows_skipped_counts_unseen_test_labels(spark):
    from pyspark.sql import functions as F

    from tabml.operators.features import FeatureSpec
    from tabml.operators.split import hash_split
    from tabml.plans.jobs import JobSpec, TaskSpec

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    _, test = hash_split(orders, ["o_orderkey"], (0.7, 0.3))
    rare = [r.o_orderkey for r in test.orderBy("o_orderkey").limit(3).collect()]  # 3 test rows get a new label

    def source(s, d):
        o = s.read.parquet(f"{d}/orders.parquet")
        lab = F.when(F.col("o_orderkey").isin(rare), F.lit("RARE")).otherwise(F.col("o_orderstatus"))
        return o.select("o_orderkey", "o_totalprice", lab.alias("status"))

    job = JobSpec("rare", source, ["o_orderkey"], [
        TaskSpec("rare_clf", "classification", FeatureSpec(numeric=["o_totalprice"], handle_invalid="skip"), "status",
                 "logistic", {"maxIter": 5})])
    m = _metrics(run_job(spark, job, SF_SMALL))
    assert m[("test", "rows_skipped")] == 3
    assert m[("test", "n")] == test.count() - 3
    strict = TaskSpec("rare_clf", "classification", FeatureSpec(numeric=["o_totalprice"]), "status", "logistic", {"maxIter": 5})
    with pytest.raises(Exception, match="Unseen label"):
        run_job(spark, JobSpec("rare", source, ["o_orderkey"], [strict]), SF_SMALL)


def test_rows_skipped_for_every_task_kind(spark):
    from dataclasses import replace

    from pyspark.sql import functions as F

    job = JOB_BY_NAME["cars"]

    def source(s, d):  # a tenth of the brands are NULL
        p = job.source(s, d)
        return p.withColumn("p_brand", F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")))

    rows = run_job(spark, replace(job, source=source), SF_SMALL).collect()
    skipped = {r.task: r.value for r in rows if r.metric == "rows_skipped"}
    assert set(skipped) == {"cars_reg", "cars_clf", "cars_clu"} and all(v > 0 for v in skipped.values())


def test_source_is_cut_to_the_columns_that_are_used(spark):
    from dataclasses import replace

    from tabml.plans.jobs import used_columns

    job = JOB_BY_NAME["iris"]
    seen = {}

    def source(s, d):
        seen["df"] = job.source(s, d)
        return seen["df"]

    run_job(spark, replace(job, source=source, tasks=job.tasks[:1]), SF_SMALL)
    used = used_columns(replace(job, tasks=job.tasks[:1]))
    assert used == {"l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"}
    assert used < set(seen["df"].columns)


def test_onehot_coefficients_name_every_slot(spark):
    from tabml.operators.features import FeatureSpec
    from tabml.plans.jobs import JobSpec, TaskSpec

    def source(s, d):
        return s.read.parquet(f"{d}/customer.parquet")

    spec = FeatureSpec(numeric=["c_nationkey"], one_hot=["c_mktsegment"])
    for kind, target, est in (("regression", "c_acctbal", "linear"), ("classification", "c_nationkey_parity", "logistic")):
        src = source if kind == "regression" else lambda s, d: source(s, d).selectExpr("*", "string(c_nationkey % 2) AS c_nationkey_parity")
        task = TaskSpec("t", kind, spec, target, est, {"maxIter": 5}, reports=("coefficients", "fit_status")[: 2 if kind != "regression" else 1])
        m = _metrics(run_job(spark, JobSpec("j", src, ["c_custkey"], [task]), SF_SMALL))
        assert sum("c_mktsegment_encoded_" in k for _, k in m) == 4
        if kind != "regression":
            assert m[("train", "converged")] in (0.0, 1.0)


def test_metrics_sink_is_idempotent_per_run(spark, tmp_path):
    out = str(tmp_path / "metrics")
    job = task_job("price_reg")
    n = run_job(spark, job, SF_SMALL, sink=out, run_id="a").count()
    run_job(spark, job, SF_SMALL, sink=out, run_id="a")
    run_job(spark, job, SF_SMALL, sink=out, run_id="b")
    back = spark.read.parquet(out)
    assert {r.run_id: r["count"] for r in back.groupBy("run_id").count().collect()} == {"a": n, "b": n}


def test_appended_files_are_read(spark, tmp_path):
    from tabml.sources import load_table

    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    assert load_table(spark, str(tmp_path), "t").count() == 3
    spark.range(2).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert load_table(spark, str(tmp_path), "t").count() == 5


def test_sparse_cluster_report_does_not_expand_rows(spark):
    from tabml.operators import evaluate as K
    from tabml.operators.features import FeatureSpec, fit_features

    df = spark.range(20_000).selectExpr("string(id % 10000) AS level", "double(id % 3) AS x", "int(id % 2) AS prediction")
    v = fit_features(FeatureSpec(numeric=["x"], one_hot=["level"]), df).transform(df)
    spread = K._spread(v, "features", "prediction")
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "vector_to_array" not in plan and "UDF(features" not in plan.split("Aggregate")[0]
    centers = [[0.0] * 10_000] * 2
    w = K.wssse(v, "features", "prediction", centers).first()
    want = sum(x * x for x in (i % 3 for i in range(20_000))) + sum(1 for i in range(20_000) if (i % 10_000) != 9_999)
    assert w.n == 20_000 and abs(w.wssse - want) < 3


def test_a_condition_of_one_task_leaves_the_others_alone(spark):
    from dataclasses import replace

    job = JOB_BY_NAME["youtube"]
    rows = run_job(spark, job, SF_SMALL).collect()
    clu = {r.metric: r.value for r in rows if r.task == "youtube_clu"}
    source = job.source(spark, SF_SMALL)
    kept = source.filter("subscribers > 1000 AND subscribers < 1e8 AND views < 1e10").count()
    assert clu["rows_trimmed"] == source.count() - kept > 0
    assert sum(v for k, v in clu.items() if k.startswith("size_rank")) == kept
    assert not any(r.metric == "rows_trimmed" for r in rows if r.task != "youtube_clu")
    none = replace(task_job("youtube_clu"), tasks=[replace(task_job("youtube_clu").tasks[0], where="subscribers > NULL OR `views` > 5")])
    got = {r.metric: r.value for r in run_job(spark, none, SF_SMALL).collect()}
    assert got["rows_trimmed"] == source.filter("views <= 5").count()  # a condition that is NULL does not hold


def test_top_groups_of_a_job(spark):
    job = JOB_BY_NAME["youtube"]
    got = [(r.metric, r.value) for r in run_job(spark, job, SF_SMALL).collect() if "_n_country_" in r.metric and r.task == "source"]
    want = job.source(spark, SF_SMALL).groupBy("country").count().orderBy("count", ascending=False).collect()
    assert len(got) == min(10, len(want)) and got[0][1] == want[0]["count"]
    assert [v for _, v in got] == sorted((v for _, v in got), reverse=True)


@pytest.mark.parametrize("task, prefix", [("iris_clf", "sample_"), ("iris_clu", "sample_"), ("medical_clf", "sample_"), ("cars_clf", "sample_")])
def test_samples_of_classes_and_clusters(spark, task, prefix):
    sample = [(r.metric, r.value) for r in run_job(spark, task_job(task), SF_SMALL).collect() if r.metric.startswith(prefix)]
    assert len(sample) == 10
    for k, v in sample:
        if "_actual_" in k:
            actual, predicted = k.split("_actual_")[1].split("_predicted_")
            assert v == float(actual == predicted)
        else:
            assert k.endswith("_rank") and v in (1, 2, 3)


def test_unknown_sample_is_an_error(spark):
    from dataclasses import replace

    job = task_job("iris_clf")
    with pytest.raises(ValueError):
        run_job(spark, replace(job, tasks=[replace(job.tasks[0], sample="random")]), SF_SMALL)


def test_fit_check_tells_a_stopped_fit(spark):
    from dataclasses import replace

    job = task_job("medical_clf")
    for max_iter, ok in ((100, True), (1, False)):
        t = replace(job.tasks[0], params={"maxIter": max_iter}, reports=("fit_check", "fit_status"))
        m = _metrics(run_job(spark, replace(job, tasks=[t]), SF_SMALL))
        assert m[("train", "converged")] == float(ok) and (m[("train", "gradient")] < 1e-5) == ok
