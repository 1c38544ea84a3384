"""Plan-shape regression tests: scale properties asserted on the physical plans, not on results."""

import pytest

import __spark_entry__ as E
from tabml.plans import catalog
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


RELATIONAL = [
    k for k, fn in E.queries().items()
    if fn.__module__.endswith(("relational_queries", "evaluate_queries", "feature_queries"))
]


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_joins_and_no_python_workers(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan and "MapInPandas" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(E.queries()["filter_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double,l_tax:double>" in plan


def test_top_k_filter_is_a_broadcast_semi_join(spark):
    plan = _plan(E.queries()["topk_semi_filter"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "TakeOrderedAndProject" in plan


def test_hash_split_adds_no_exchange(spark):
    from tabml.operators.split import hash_split

    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    train, _ = hash_split(df, ["o_orderkey"], (0.7, 0.3))
    plan = _plan(train)
    assert "Exchange" not in plan and "Sort" not in plan and "hash(" in plan


def test_confusion_metrics_scan_once(spark):
    df = E.queries()["eval_f1_weighted"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1  # the second reader of the confusion table reuses the exchange
    assert "ReusedExchange" in final


def test_profile_is_one_aggregate(spark):
    plan = _plan(E.queries()["describe_numeric"](spark, SF_SMALL))
    assert plan.count("Exchange") == 1


def test_every_query_has_a_kind():
    own = {k for k, fn in E.queries().items() if fn.__module__.startswith("tabml.plans.")}
    assert set(catalog.KIND) == own == set(catalog.QUERIES)
