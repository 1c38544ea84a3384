"""Jobs from plain data (JSON / dict) instead of Python code.

    {
      "name": "orders_price",
      "source": {"table": "orders",
                 "derive": {"month": "month(o_orderdate)", "day_of_week": "dayofweek(o_orderdate)",
                            "o_custkey": "CAST(o_custkey AS DOUBLE)"},
                 "filter": "o_totalprice > 0"},
      "keys": ["o_orderkey"], "weights": [0.7, 0.3], "seed": 42,
      "tasks": [{"name": "price", "kind": "regression", "target": "o_totalprice", "estimator": "linear",
                 "features": {"numeric": ["o_custkey", "month", "day_of_week"], "output": "reg_features"},
                 "params": {"maxIter": 10}, "reports": ["coefficients"]}]
    }

Derived columns and the filter are Spark SQL expressions, handed to ``F.expr`` (Catalyst parses and
optimises them like any other plan); the result is an ordinary ``JobSpec`` for ``run_job``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.features import FeatureSpec
from tabml.plans.jobs import REPORTS, JobSpec, TaskSpec
from tabml.sources import load_table

# Keys a job definition may have; anything else (a misspelt option) is an error, never silently left out.
_SOURCE_KEYS = {"table", "derive", "filter", "select"}
_FEATURE_KEYS = {"numeric", "one_hot", "indexed", "output", "handle_invalid", "scale", "drop_last"}
_TASK_FIELDS = {
    "fit_scope", "eval_split", "feature_scope", "profile_by", "band_col", "binary",
    "top_classes", "where", "sample",
}


def _known(what: str, given: Mapping, keys: set[str]) -> None:
    unknown = sorted(set(given) - keys)
    if unknown:
        raise ValueError(f"unknown {what} keys: {', '.join(unknown)}")


def source_from_dict(spec: Mapping):
    _known("source", spec, _SOURCE_KEYS)
    table = spec["table"]
    derive = dict(spec.get("derive", {}))
    cond = spec.get("filter")
    columns = spec.get("select")

    def source(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = load_table(spark, sf_dir, table)
        if derive:
            df = df.withColumns({name: F.expr(expr) for name, expr in derive.items()})
        if cond:
            df = df.filter(F.expr(cond))
        if columns:
            df = df.select(*columns)
        return df

    return source


def task_from_dict(t: Mapping) -> TaskSpec:
    f = t.get("features", {})
    _known("feature", f, _FEATURE_KEYS)
    _known("task", t, _TASK_FIELDS | {"name", "kind", "features", "target", "estimator", "params", "reports", "band_bounds"})
    unknown = sorted(set(t.get("reports", ())) - REPORTS)
    if unknown:
        raise ValueError(f"unknown reports: {', '.join(unknown)}")
    features = FeatureSpec(
        numeric=f.get("numeric", ()),
        one_hot=f.get("one_hot", ()),
        indexed=f.get("indexed", ()),
        output=f.get("output", "features"),
        handle_invalid=f.get("handle_invalid", "error"),
        scale=f.get("scale"),
        drop_last=bool(f.get("drop_last", True)),
    )
    extra = {k: t[k] for k in _TASK_FIELDS if k in t}
    return TaskSpec(
        name=t["name"],
        kind=t["kind"],
        features=features,
        target=t.get("target"),
        estimator=t.get("estimator", "linear"),
        params=dict(t.get("params", {})),
        reports=tuple(t.get("reports", ())),
        band_bounds=tuple(t.get("band_bounds", ())),
        **extra,
    )


def job_from_dict(d: Mapping) -> JobSpec:
    _known("job", d, {"name", "source", "keys", "tasks", "weights", "seed", "split_mode", "materialize", "report_split_sizes", "profile_cols", "top_report", "top_groups"})
    return JobSpec(
        name=d["name"],
        source=source_from_dict(d["source"]),
        keys=tuple(d["keys"]),
        tasks=[task_from_dict(t) for t in d["tasks"]],
        weights=tuple(d.get("weights", (0.7, 0.3))),
        seed=int(d.get("seed", 42)),
        split_mode=d.get("split_mode", "hash"),
        materialize=d.get("materialize", "persist"),
        report_split_sizes=bool(d.get("report_split_sizes", False)),
        profile_cols=tuple(d.get("profile_cols", ())),
        top_report=tuple(d["top_report"]) if "top_report" in d else None,
        top_groups=tuple(d["top_groups"]) if "top_groups" in d else None,
    )


def job_from_json(path: str) -> JobSpec:
    with open(path) as fh:
        return job_from_dict(json.load(fh))
