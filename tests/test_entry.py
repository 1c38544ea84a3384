import os

import duckdb
import pytest

import __spark_entry__ as E
from tabml.plans import catalog
from tabml.sources import TABLES
from tests.conftest import SF_CHECK


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["n", "rmse", "r2", "mae", "mape"]


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90
    assert all(catalog.KIND[k] in "ECSPR" for k in catalog.QUERIES)


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_CHECK}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


FAST = ["ols_holdout_metrics", "topk_semi_filter", "describe_numeric", "eval_f1_weighted", "eval_auc",
        "one_hot", "string_index_skip", "parse_duration", "split_hash_counts", "eval_silhouette"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    sdf = E.queries()[name](spark, SF_CHECK)
    cols = sorted(sdf.columns)
    got = sorted((tuple(r[c] for c in cols) for r in sdf.collect()), key=repr)
    rel = _duck().execute(E.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted((tuple(row[i] for i in idx) for row in rel.fetchall()), key=repr)
    assert got == want
