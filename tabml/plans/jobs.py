"""Job specifications and the job runner.

A ``JobSpec`` is one analysis: a source (read + clean + derive, as a DataFrame plan), a split, and tasks
(classification, regression, clustering) each with a feature spec, an estimator and the reports to produce.
``run_job`` executes it and returns a tidy metric table (job, task, split, metric, value), optionally appended
to the parquet metrics sink.

Plan shape, chosen for scale:
* the cleaned source is cut to the columns that keys, features, targets and reports use, persisted (MEMORY_AND_DISK)
  only when several passes read it, and released after;
* the split is a hash of the key columns (no shuffle, repeatable on any cluster);
* label indexers and feature stages are fitted on the train part only, and a feature model shared by several
  tasks of a job is fitted once;
* every metric family is one aggregate; only model parameters and metrics of a size fixed by the task reach the driver;
  tables whose size follows a column's values (contingencies, class counts) stay plans and join the result as frames.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions import band, hash32
from tabml.operators import evaluate as K
from tabml.operators import fixed_point as P
from tabml.operators import forest as W
from tabml.operators import inspect as I
from tabml.operators import models as M
from tabml.operators.features import FeatureSpec, fit_features, label_indexer
from tabml.operators.relational import describe_numeric, top_k_groups
from tabml.operators.split import hash_split, random_split, with_split_column
from tabml.session import ensure_checkpoint_dir
from tabml.sources import write_metrics

SourceFn = Callable[[SparkSession, str], DataFrame]

#: Reports a task can ask for.
REPORTS = frozenset(
    "silhouette wssse centers cluster_means train_summary coefficients label_stats banded auc class_balance train_accuracy contingency fit_status sample_rows fit_check".split()
)
SAMPLE_ROWS = 10
RESULT = "job string, task string, split string, metric string, value double"


@dataclass(frozen=True)
class TaskSpec:
    name: str
    kind: str  # classification | regression | clustering
    features: FeatureSpec
    target: str | None = None
    estimator: str = "linear"  # linear | logistic | forest | kmeans
    params: dict = field(default_factory=dict)
    fit_scope: str = "train"  # train | all  (clustering may fit on all rows)
    eval_split: str = "test"  # test | train | all
    # Part the feature stages and label indexer are fitted on.  "train" avoids leakage; "all" reproduces
    # analyses that indexed before splitting.  Defaults to the estimator's fit scope.
    feature_scope: str | None = None
    profile_by: str | None = None  # clustering: also count rows per (cluster, this column)
    reports: Sequence[str] = ()
    band_col: str | None = None
    band_bounds: Sequence[float] = ()
    binary: bool = False
    top_classes: int | None = None  # classification: keep only rows of the k most frequent classes
    where: str | None = None  # SQL condition on the source's columns for this task alone (rows it does not hold for go)
    sample: str = "first"  # the rows of the sample_rows report: first by key, or by "hash" of the key


@dataclass(frozen=True)
class JobSpec:
    name: str
    source: SourceFn
    keys: Sequence[str]
    tasks: Sequence[TaskSpec]
    weights: Sequence[float] = (0.7, 0.3)
    seed: int = 42
    split_mode: str = "hash"  # hash | random
    # How a source shared by several tasks is kept: "persist" (MEMORY_AND_DISK; lost blocks are recomputed from
    # lineage) or "checkpoint" (written once to the shared spark.checkpoint.dir; survives executor loss without
    # recomputation and cuts the lineage), or "none".
    materialize: str = "persist"
    report_split_sizes: bool = False  # rows per part, from one aggregate over a split column
    # count / mean / stddev / min / max of the cleaned source's columns (text columns: their count), one aggregate
    profile_cols: Sequence[str] = ()
    top_report: tuple[str, int] | None = None  # (column, n): the n rows with the largest values, by key
    top_groups: tuple[str, int] | None = None  # (column, n): the n most frequent values and their counts


def _estimator(task: TaskSpec, label_col: str):
    """Estimator with the library defaults, then the task's own Spark parameters (camelCase) on top."""
    if task.estimator == "linear":
        est = M.linear_regression(label=label_col)
    elif task.estimator == "logistic":
        est = M.logistic_regression(label=label_col)
    elif task.estimator == "forest" and task.kind == "regression":
        est = M.random_forest_regressor(label=label_col)
    elif task.estimator == "forest":
        est = M.random_forest_classifier(label=label_col)
    elif task.estimator == "kmeans":
        est = M.kmeans(features=task.features.output)
    else:
        raise ValueError(f"unknown estimator {task.estimator!r}")
    return est.setParams(**task.params) if task.params else est


def round_sig(v, digits: int | None):
    """Round a metric to ``digits`` significant digits; whole numbers (counts) are kept exact."""
    if v is None:
        return None
    v = float(v)
    if digits is None or v != v or v in (float("inf"), float("-inf")) or v == int(v):
        return v
    return float(f"{v:.{digits}g}")


class _Rows:
    """Metrics of one task: rows of a size the task fixes, and frames whose size follows the data's values."""

    def __init__(self, job: str, task: str, digits: int | None = None):
        self.job, self.task, self.rows, self.digits = job, task, [], digits
        self.frames: list[DataFrame] = []
        self.held: list[DataFrame] = []  # persisted while the result is computed

    def add(self, split: str, metrics: dict) -> None:
        for k, v in metrics.items():
            self.rows.append((self.job, self.task, split, k, round_sig(v, self.digits)))

    def add_frame(self, split: str, df: DataFrame, metric: Column, value: Column) -> None:
        value = value.cast("double")
        if self.digits is not None:
            short = F.format_string(f"%.{self.digits - 1}e", value).cast("double")
            value = F.when(value == F.floor(value), value).otherwise(short)
        self.frames.append(
            df.select(F.lit(self.job).alias("job"), F.lit(self.task).alias("task"), F.lit(split).alias("split"), metric.alias("metric"), value.alias("value"))
        )

    def hold(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df


#: A fit that its iteration limit stopped is held to these: the share of the cost that one more k-means step would gain,
#: and the length of a Newton step of a logistic fit.  One that ended by itself is held to the estimator's tolerance, or
#: to GRADIENT for a logistic fit, whose tolerance is on the loss.
STEP_GAIN, NEWTON_STEP, GRADIENT = 1e-3, 0.1, 1e-5


def _beyond(value: float, limit: float) -> float:
    """``value`` where it is beyond the limit, else 0."""
    return value if value > limit else 0.0


def _first_row(df: DataFrame) -> dict:
    return df.collect()[0].asDict()  # one-row aggregate


def _skipped(spec: FeatureSpec, eval_df: DataFrame, n: int) -> dict:
    """Rows of the evaluated part that have no prediction: only ``skip`` drops rows, so only it needs a count."""
    return {"rows_skipped": eval_df.count() - n if spec.handle_invalid == "skip" else 0}


def _sampled(task: TaskSpec, job: JobSpec, scored: DataFrame) -> DataFrame:
    """The rows that ``sample_rows`` lists, under their key."""
    order = [hash32(job.keys, job.seed + 1)] if task.sample == "hash" else []
    return scored.select(F.concat_ws("_", *[F.col(k) for k in job.keys]).alias("_key"), "*").orderBy(*order, *job.keys).limit(SAMPLE_ROWS)


def _sample_rows(task: TaskSpec, job: JobSpec, out: _Rows, scored: DataFrame, label: str, prediction: str) -> None:
    """Label, prediction and absolute error of the sampled rows."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    long = _sampled(task, job, scored).select("_key", y.alias("actual"), p.alias("predicted"), F.abs(y - p).alias("abs_error"))
    long = long.unpivot(["_key"], ["actual", "predicted", "abs_error"], "what", "v")
    out.add_frame(task.eval_split, long, F.concat(F.lit("sample_"), F.col("_key"), F.lit("_"), F.col("what")), F.col("v"))


def _run_clustering(task: TaskSpec, job: JobSpec, fit_x: DataFrame, eval_x: DataFrame, eval_df: DataFrame, out: _Rows) -> None:
    km = M.fit_on(_estimator(task, ""), fit_x)
    scored = km.transform(eval_x)
    pred = task.params.get("predictionCol", "prediction")
    centers = [c.tolist() for c in km.clusterCenters()]
    numeric = list(task.features.numeric) if "cluster_means" in task.reports else []
    # sizes, WSSSE and cluster means in one grouped pass (k rows come back)
    prof = K.cluster_profile(scored, task.features.output, pred, centers, numeric).collect()
    # clusters are named by their rank in size: the model's own numbering is arbitrary
    rank = {r["cluster"]: i for i, r in enumerate(sorted(prof, key=lambda r: (-r["size"], r["cluster"])))}
    rank |= {c: i for i, c in enumerate((c for c in range(len(centers)) if c not in rank), len(rank))}
    metrics = I.kmeans_summary(km)
    if "silhouette" in task.reports:
        metrics["silhouette"] = K.silhouette(scored, task.features.output, pred)
    if "wssse" in task.reports:
        metrics["wssse"] = sum(r["sse"] for r in prof)
    if "fit_status" in task.reports:
        metrics |= M.fit_status(km)
    metrics |= _skipped(task.features, eval_df, sum(r["size"] for r in prof))
    for r in sorted(prof, key=lambda r: rank[r["cluster"]]):
        metrics[f"size_rank{rank[r['cluster']] + 1}"] = r["size"]
        for c in numeric:
            metrics[f"mean_{c}_rank{rank[r['cluster']] + 1}"] = r[f"mean_{c}"]
    if "centers" in task.reports:
        for ci, c in enumerate(centers):
            for d, v in enumerate(c):
                metrics[f"center_rank{rank[ci] + 1}_dim{d}"] = float(v)
    out.add(task.eval_split, metrics)
    if "fit_check" in task.reports:
        step = P.kmeans_step(km.transform(fit_x), task.features.output, pred, centers)
        held = step["center_shift"] if (ended := bool(M.fit_status(km)["converged"])) else step["step_gain"]
        step["residual"] = _beyond(held, km.getTol() if ended else STEP_GAIN)
        out.add(task.fit_scope, step)
    if "sample_rows" in task.reports:
        ranks = F.array(*[F.lit(rank[c] + 1) for c in range(len(centers))])
        rows = _sampled(task, job, scored).select("_key", F.get(ranks, F.col(pred).cast("int")).alias("r"))
        out.add_frame(task.eval_split, rows, F.concat(F.lit("sample_"), F.col("_key"), F.lit("_rank")), F.col("r"))
    if task.profile_by:
        ranks = F.array(*[F.lit(rank[c] + 1) for c in range(len(centers))])
        table = scored.groupBy(F.get(ranks, F.col(pred).cast("int")).alias("r"), F.col(task.profile_by).cast("string").alias("v")).count()
        name = F.concat(F.lit("n_rank"), F.col("r"), F.lit(f"_{task.profile_by}_"), F.coalesce("v", F.lit("NULL")))
        out.add_frame(task.eval_split, table, name, F.col("count"))


def _run_regression(task: TaskSpec, job: JobSpec, model, scored: DataFrame, eval_df: DataFrame, all_df: DataFrame, names: list[str], out: _Rows) -> None:
    label_col, pred_col = "label", task.params.get("predictionCol", "prediction")
    m = _first_row(K.regression_metrics(scored, label_col, pred_col))
    out.add(task.eval_split, {k: m[k] for k in ("n", "rmse", "mse", "mae", "r2", "mape", "mape_excluded")})
    out.add(task.eval_split, _skipped(task.features, eval_df, m["n"] + m["excluded"]))
    if "train_summary" in task.reports and task.estimator == "linear":
        s = I.regression_summary(model)
        out.add("train", {"r2": s["r2"], "rmse": s["rmse"]})
    if "coefficients" in task.reports and task.estimator == "linear":
        coefs = {f"coef_{n}": float(v) for n, v in zip(names, model.coefficients.toArray(), strict=True)}
        out.add("train", coefs | {"intercept": float(model.intercept)})
    if "label_stats" in task.reports:
        st = _first_row(
            all_df.agg(
                F.avg(task.target).alias("mean"), F.stddev_samp(task.target).alias("std"),
                F.min(task.target).alias("min"), F.max(task.target).alias("max"),
            )
        )
        out.add("all", {f"label_{k}": v for k, v in st.items()})
        if st["std"]:
            out.add(task.eval_split, {"rmse_std_ratio": m["rmse"] / st["std"]})
    if "banded" in task.reports and task.band_col:
        rep = K.banded_errors(scored, band(task.band_col, task.band_bounds), label_col, pred_col).collect()
        for r in rep:  # one row per band of the task
            out.add(task.eval_split, {f"mae_band_{r['band']}": r["avg_abs_error"], f"n_band_{r['band']}": r["count"]})
    if "sample_rows" in task.reports:
        _sample_rows(task, job, out, scored, label_col, pred_col)
    if "fit_check" in task.reports and task.estimator == "forest":
        out.add(task.eval_split, _first_row(W.walk_check(scored, model, list(job.keys), pred_col)))


def _run_classification(
    task: TaskSpec, job: JobSpec, model, labels: list[str], fit_x: DataFrame, scored: DataFrame, eval_df: DataFrame, names: list[str], out: _Rows
) -> None:
    label_col, pred_col = "label", task.params.get("predictionCol", "prediction")
    whole, auc = scored, task.binary and "auc" in task.reports
    if auc:  # the rows are scored once for the confusion and the curve
        score = vector_to_array("probability")[1].alias("_score")
        scored = out.hold(scored.select(label_col, pred_col, score))
    # one confusion pass; every count-based metric derives from that table
    conf = out.hold(K.confusion(scored, label_col, pred_col))
    m = _first_row(K.metrics_from_confusion(conf))
    out.add(task.eval_split, {k: m[k] for k in ("n", "accuracy", "weighted_precision", "weighted_recall", "weighted_f1")})
    out.add(task.eval_split, _skipped(task.features, eval_df, m["n"] or 0))
    if task.binary:
        b = _first_row(K.binary_from_confusion(conf))
        out.add(task.eval_split, {k: b[k] for k in ("tp", "tn", "fp", "fn", "precision", "recall", "f1")})
    if auc:
        out.add(task.eval_split, {"auc": K.area_under_roc(scored, label_col, "_score")})
    # class names by a table, not by a literal: there may be thousands
    classes = fit_x.sparkSession.createDataFrame([(float(i), x) for i, x in enumerate(labels)], "_index double, _name string")

    def named(df: DataFrame, c: str, as_: str) -> DataFrame:
        return df.join(classes.select(F.col("_index").alias(c), F.col("_name").alias(as_)), c, "left")

    if "contingency" in task.reports:
        pairs = named(named(conf, "label", "_actual"), "prediction", "_predicted")
        out.add_frame(task.eval_split, pairs, F.concat(F.lit("n_actual_"), "_actual", F.lit("_predicted_"), "_predicted"), F.col("count"))
    if "class_balance" in task.reports:
        totals = named(conf.groupBy("label").agg(F.sum("count").alias("n")), "label", "_actual")
        out.add_frame(task.eval_split, totals, F.concat(F.lit("n_label_"), "_actual"), F.col("n"))
    if "sample_rows" in task.reports:  # 1 where the class is right
        rows = _sampled(task, job, whole).select("_key", "label", F.col(pred_col).alias("prediction"))
        rows = named(named(rows, "label", "_actual"), "prediction", "_predicted")
        metric = F.concat(F.lit("sample_"), "_key", F.lit("_actual_"), "_actual", F.lit("_predicted_"), "_predicted")
        out.add_frame(task.eval_split, rows, metric, (F.col("label") == F.col("prediction")).cast("int"))
    if "fit_check" in task.reports and task.estimator == "forest":
        out.add(task.eval_split, _first_row(W.walk_check(whole, model, list(job.keys), pred_col)))
    if "fit_check" in task.reports and task.estimator == "logistic":
        check = P.logistic_gradient(model.transform(fit_x), task.features.output, label_col, model.getProbabilityCol(), model.numClasses)
        ended = bool(M.fit_status(model)["converged"])
        check["residual"] = _beyond(check["gradient"], GRADIENT) if ended else _beyond(check["newton_step"], NEWTON_STEP)
        out.add(task.fit_scope, check)
    if "train_accuracy" in task.reports and task.estimator == "logistic":
        out.add("train", {"accuracy": I.classification_summary(model)["accuracy"]})
    if "fit_status" in task.reports and task.estimator == "logistic":
        out.add("train", M.fit_status(model))
    if "coefficients" in task.reports and task.estimator == "logistic":
        out.add("train", {f"coef_{c}_{t}": v for c, t, v in I.class_coefficients(model, names, labels)})


def _run_task(job: JobSpec, task: TaskSpec, parts: dict, feature_cache: dict, digits: int | None) -> _Rows:
    out = _Rows(job.name, task.name, digits)
    task.features.check_target(task.target)
    unknown = set(task.reports) - REPORTS
    if unknown:
        raise ValueError(f"unknown reports: {', '.join(sorted(unknown))}")
    if task.sample not in ("first", "hash"):
        raise ValueError(f"unknown sample {task.sample!r}")
    if task.where:
        kept = F.coalesce(F.expr(task.where), F.lit(False))
        out.add(task.eval_split, {"rows_trimmed": parts[task.eval_split].agg(F.count_if(~kept)).first()[0]})
        parts = {name: df.filter(kept) for name, df in parts.items()}
    if task.top_classes:  # a k-row table, the same for every part
        top = top_k_groups(parts["all"].filter(F.col(task.target).isNotNull()), task.target, task.top_classes).select(task.target)
        parts = {name: df.join(top, task.target, "left_semi") for name, df in parts.items()}
    fit_df = parts["all"] if task.fit_scope == "all" else parts["train"]
    eval_df = parts[task.eval_split]
    feature_scope = task.feature_scope or task.fit_scope
    feature_df = parts["all"] if feature_scope == "all" else parts["train"]

    # Feature model: fitted once per (features, scope) within a job, on that part only.
    fkey = (task.features, feature_scope, task.where, task.top_classes and (task.target, task.top_classes))
    if fkey not in feature_cache:
        feature_cache[fkey] = fit_features(task.features, feature_df)
    fmodel: PipelineModel = feature_cache[fkey]
    fit_x = fmodel.transform(fit_df)
    eval_x = fmodel.transform(eval_df)

    if task.kind == "clustering":
        _run_clustering(task, job, fit_x, eval_x, eval_df, out)
        return out

    label_col, labels = "label", []
    if task.kind == "classification":
        lab_df = fit_x if feature_scope == task.fit_scope else fmodel.transform(feature_df)
        lab = label_indexer(task.target, label_col, handle_invalid=task.features.handle_invalid).fit(lab_df)
        fit_x, eval_x, labels = lab.transform(fit_x), lab.transform(eval_x), list(lab.labels)
    else:
        fit_x = fit_x.withColumn(label_col, F.col(task.target).cast("double"))
        eval_x = eval_x.withColumn(label_col, F.col(task.target).cast("double"))

    model = M.fit_on(_estimator(task, label_col).setFeaturesCol(task.features.output), fit_x)
    scored = model.transform(eval_x)
    names = I.slot_names(fit_x, task.features.output, model.numFeatures)
    if task.kind == "regression":
        _run_regression(task, job, model, scored, eval_df, parts["all"], names, out)
    else:
        _run_classification(task, job, model, labels, fit_x, scored, eval_df, names, out)
    return out


def _job_reports(job: JobSpec, src: DataFrame, digits: int | None) -> _Rows:
    """Job-level reports on the cleaned source (task name ``source``)."""
    out = _Rows(job.name, "source", digits)
    if job.report_split_sizes and job.split_mode == "hash":
        labelled = with_split_column(src, job.keys, job.weights, job.seed, names=("train", "test"))
        for r in labelled.groupBy("split").count().collect():  # two rows
            out.add("all", {f"rows_{r['split']}": r["count"]})
    if job.profile_cols:
        text = [c for c in job.profile_cols if src.schema[c].dataType.typeName() == "string"]
        numeric = [c for c in job.profile_cols if c not in text]
        for r in describe_numeric(src, numeric).collect() if numeric else []:  # one row per column
            out.add("all", {f"{stat}_{r['column']}": r[stat] for stat in ("count", "mean", "stddev", "min", "max")})
        if text:
            counts = src.agg(*[F.count(c).alias(f"count_{c}") for c in text], *[F.count_distinct(c).alias(f"distinct_{c}") for c in text])
            out.add("all", _first_row(counts))
    if job.top_report:
        c, n = job.top_report
        best = src.select(F.concat_ws("_", *[F.col(k) for k in job.keys]).alias("key"), *job.keys, c).orderBy(F.desc(c), *job.keys).limit(n)
        for i, r in enumerate(best.collect()):  # n rows
            out.add("all", {f"top{i + 1}_{c}_{r['key']}": r[c]})
    if job.top_groups:
        c, n = job.top_groups
        for i, r in enumerate(top_k_groups(src, c, n).collect()):  # n rows
            out.add("all", {f"top{i + 1}_n_{c}_{'NULL' if r[c] is None else r[c]}": r["count"]})
    return out


def used_columns(job: JobSpec) -> set[str]:
    """Columns of the source that the job reads (of a task's condition: every name in it)."""
    used = {*job.keys, *job.profile_cols} | {report[0] for report in (job.top_report, job.top_groups) if report}
    for t in job.tasks:
        used |= set(re.findall(r"`([^`]+)`", t.where or "")) | set(re.findall(r"\w+", t.where or ""))
        used |= {*t.features.numeric, *t.features.one_hot, *t.features.indexed} | {c for c in (t.target, t.band_col, t.profile_by) if c}
    return used


def _passes(job: JobSpec) -> int:
    """At least so many passes over the source: a scaler, an iterative fit and a report each read it."""
    return sum(1 + (t.features.scale is not None) + (t.kind == "clustering") for t in job.tasks)


def run_job(
    spark: SparkSession, job: JobSpec, sf_dir: str, sink: str | None = None, digits: int | None = None, run_id: str | None = None
) -> DataFrame:
    """Run every task of ``job``; metric values optionally rounded to ``digits`` significant digits.

    ``sink`` also writes the result (see ``write_metrics``; the same ``run_id`` replaces the run's rows)."""
    if job.materialize not in ("persist", "checkpoint", "none"):
        raise ValueError(f"unknown materialize mode {job.materialize!r}")
    if job.split_mode != "hash" and job.materialize != "checkpoint":
        # randomSplit repeats only for identical rows in identical partitions: a recomputed shuffle could move rows
        raise ValueError("a random split needs materialize='checkpoint'")
    src = job.source(spark, sf_dir)
    used = used_columns(job)
    src = src.select(*[F.col("`" + c.replace("`", "``") + "`") for c in src.columns if c in used])
    shared = job.materialize == "persist" and _passes(job) > 1
    if job.materialize == "checkpoint":
        ensure_checkpoint_dir(spark)
        src = src.checkpoint(eager=True)  # reliable checkpoint in the shared folder, never localCheckpoint
    elif shared:
        src = src.persist(StorageLevel.MEMORY_AND_DISK)
    done: list[_Rows] = []
    try:
        if job.split_mode == "hash":
            train, test = hash_split(src, job.keys, job.weights, job.seed)
        else:
            train, test = random_split(src, job.weights, job.seed)
        parts = {"all": src, "train": train, "test": test}
        feature_cache: dict = {}
        done.append(_job_reports(job, src, digits))
        for task in job.tasks:
            done.append(_run_task(job, task, parts, feature_cache, digits))
        result = spark.createDataFrame([r for out in done for r in out.rows], RESULT)
        frames = [f for out in done for f in out.frames]
        if frames:
            for f in frames:
                result = result.unionByName(f)
            result = result.persist(StorageLevel.MEMORY_AND_DISK)  # metrics only; computed while the source is held
            result.count()
    finally:
        for df in [d for out in done for d in out.held]:
            df.unpersist()
        if shared:
            src.unpersist()
    if sink:
        write_metrics(result, sink, run_id)
    return result
