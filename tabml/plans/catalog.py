"""Query catalogue: every operator as a named query ``(spark, sf_dir) -> DataFrame``, plus its DuckDB oracle.

Queries read whole fixture tables.  Oracle SQL runs in DuckDB over the same parquet files (views named after
the tables).  A query without SQL (free-form model fits) is checked on rows only, with properties in pytest.

Float outputs are rounded to a fixed number of decimals chosen per metric, in both engines, so that
summation-order noise cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
KIND: dict[str, str] = {}  # E exact, C closed form, S score equations, P planted, R rows only


def query(name: str, sql: str | None = None, kind: str = "E"):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        KIND[name] = kind if sql is not None else "R"
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def load_all() -> None:
    """Import the query modules (registration happens at import)."""
    from tabml.plans import (  # noqa: F401
        evaluate_queries,
        exact_job_queries,
        feature_queries,
        fit_check_queries,
        job_queries,
        model_queries,
        relational_queries,
        scale_queries,
    )
