"""Feature-stage queries (G*): assembly, category indexing, one-hot encoding, scaling, pipelines.

Vectors never leave a query: they are turned into named double columns with ``vector_to_array``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.features import (
    FeatureSpec,
    assembler,
    feature_stages,
    one_hot_encoder,
    scaler,
    string_indexer,
    vector_columns,
)
from tabml.operators.split import hash_split
from tabml.plans.catalog import query
from tabml.plans.sqlgen import EDGE_70, hashed_sql, unit_sql
from tabml.sources import load_table


def rank_sql(table: str, col: str, name: str, where: str = "") -> str:
    """CTE body: frequency rank of each level (ties by value), as StringIndexer's frequencyDesc order."""
    w = f"WHERE {where}" if where else ""
    return (
        f"{name} AS (SELECT {col} AS lvl, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS idx "
        f"FROM {table} {w} GROUP BY {col})"
    )


def one_hot_sql(idx: str, width: int, prefix: str) -> str:
    return ", ".join(f"CASE WHEN {idx} = {j} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {prefix}{j}" for j in range(width))


# --- G01 / G02 ----------------------------------------------------------------------------------------------------
_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "assemble_numeric",
    sql="SELECT l_orderkey, l_linenumber, " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(_LI_NUM)) + " FROM lineitem",
)
def assemble_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    out = assembler(_LI_NUM, "features").transform(li)
    return out.select("l_orderkey", "l_linenumber", *vector_columns("features", [f"f{i}" for i in range(4)]))


@query(
    "assemble_mixed",
    sql=f"""
WITH {rank_sql('part', 'p_type', 'r')}
SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1, {one_hot_sql('r.idx', 5, 'f_type')}
FROM part JOIN r ON part.p_type = r.lvl
""",
)
def assemble_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns and a one-hot encoded category in one vector."""
    part = load_table(spark, sf_dir, "part")
    spec = FeatureSpec(numeric=["p_size", "p_retailprice"], one_hot=["p_type"])
    model = Pipeline(stages=feature_stages(spec)).fit(part)
    names = ["f0", "f1"] + [f"f_type{j}" for j in range(5)]
    return model.transform(part).select("p_partkey", *vector_columns("features", names))


@query(
    "assemble_indexed",
    sql=f"""
WITH c AS (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN 'f' ELSE 'm' END AS sex, c_mktsegment FROM customer),
{rank_sql('c', 'sex', 'a')}, {rank_sql('c', 'c_mktsegment', 'b')}
SELECT c_custkey, c_acctbal AS f0, a.idx AS f1, b.idx AS f2 FROM c JOIN a ON sex = a.lvl JOIN b ON c_mktsegment = b.lvl
""",
)
def assemble_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that enter the vector as their bare index, without encoding."""
    c = load_table(spark, sf_dir, "customer")
    c = c.select("c_custkey", "c_acctbal", F.when(F.col("c_custkey") % 3 == 0, "f").otherwise("m").alias("sex"), "c_mktsegment")
    spec = FeatureSpec(numeric=["c_acctbal"], indexed=["sex", "c_mktsegment"])
    model = Pipeline(stages=feature_stages(spec)).fit(c)
    return model.transform(c).select("c_custkey", *vector_columns("features", ["f0", "f1", "f2"]))


# --- G03-G06: indexing -----------------------------------------------------------------------------------------------
@query(
    "string_index",
    sql=f"""
WITH {rank_sql('customer', 'c_mktsegment', 'r')}
SELECT c_custkey, c_mktsegment, r.idx AS c_mktsegment_index FROM customer JOIN r ON c_mktsegment = r.lvl
""",
)
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load_table(spark, sf_dir, "customer")
    model = string_indexer(["c_mktsegment"]).fit(c)
    return model.transform(c).select("c_custkey", "c_mktsegment", "c_mktsegment_index")


@query(
    "string_index_skip",
    sql=f"""
WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_mktsegment FROM customer),
{rank_sql('c', 'segment', 'r', where="c_mktsegment <> 'MACHINERY' AND segment IS NOT NULL")}
SELECT c_custkey, segment, r.idx AS segment_index FROM c JOIN r ON c.segment = r.lvl
""",
)
def string_index_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``handleInvalid='skip'``: the indexer is fitted on a population without one segment; applied to all
    customers, rows whose level is unseen or NULL are dropped."""
    c = load_table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"), "c_mktsegment"
    )
    fit_rows = c.filter(F.col("c_mktsegment") != "MACHINERY")
    model = string_indexer(["segment"], handle_invalid="skip").fit(fit_rows)
    return model.transform(c).select("c_custkey", "segment", "segment_index")


@query(
    "string_index_multi",
    sql=f"""
WITH {rank_sql('part', 'p_brand', 'rb')}, {rank_sql('part', 'p_type', 'rt')}, {rank_sql('part', 'p_name', 'rn')}
SELECT p_partkey, rb.idx AS p_brand_index, rt.idx AS p_type_index, rn.idx AS p_name_index
FROM part JOIN rb ON p_brand = rb.lvl JOIN rt ON p_type = rt.lvl JOIN rn ON p_name = rn.lvl
""",
)
def string_index_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns indexed by one multi-column indexer (a single counting pass)."""
    part = load_table(spark, sf_dir, "part")
    cols = ["p_brand", "p_type", "p_name"]
    model = string_indexer(cols).fit(part)
    return model.transform(part).select("p_partkey", *[f"{c}_index" for c in cols])


@query(
    "index_fit_train_apply_test",
    sql=f"""
WITH o AS (SELECT o_orderkey, o_orderpriority,
                  CASE WHEN {unit_sql('_h')} < {EDGE_70} THEN 'train' ELSE 'test' END AS split
           FROM {hashed_sql('orders', [('o_orderkey', 'bigint')])}),
{rank_sql('o', 'o_orderpriority', 'r', where="split = 'train'")}
SELECT split, o_orderkey, r.idx AS o_orderpriority_index FROM o JOIN r ON o_orderpriority = r.lvl
""",
)
def index_fit_train_apply_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the train part only (no leakage), apply the same model to both parts."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    train, test = hash_split(o, ["o_orderkey"], (0.7, 0.3), seed=42)
    model = string_indexer(["o_orderpriority"]).fit(train)
    cols = ["o_orderkey", "o_orderpriority_index"]
    return model.transform(train).select(F.lit("train").alias("split"), *cols).unionByName(
        model.transform(test).select(F.lit("test").alias("split"), *cols)
    )


# --- G07-G09: encoding and scaling ----------------------------------------------------------------------------------
@query(
    "one_hot",
    sql=f"""
WITH {rank_sql('part', 'p_type', 'r')}
SELECT p_partkey, p_type, {one_hot_sql('r.idx', 5, 'oh')} FROM part JOIN r ON part.p_type = r.lvl
""",
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """6 levels -> length-5 vector; the last level is all zeros (``dropLast``)."""
    part = load_table(spark, sf_dir, "part")
    model = Pipeline(stages=[string_indexer(["p_type"]), one_hot_encoder(["p_type"])]).fit(part)
    return model.transform(part).select("p_partkey", "p_type", *vector_columns("p_type_encoded", [f"oh{j}" for j in range(5)]))


_SCALE_COLS = ["l_quantity", "l_discount", "l_tax"]


@query(
    "scale_std",
    sql="WITH s AS (SELECT "
    + ", ".join(f"stddev_samp({c}) AS s{i}" for i, c in enumerate(_SCALE_COLS))
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({c} / s{i}, 8) AS z{i}" for i, c in enumerate(_SCALE_COLS))
    + " FROM lineitem, s",
)
def scale_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit (sample) standard deviation, no centring — the scaler's defaults."""
    li = load_table(spark, sf_dir, "lineitem")
    model = Pipeline(stages=[assembler(_SCALE_COLS, "raw"), scaler("raw", "scaled")]).fit(li)
    cols = vector_columns("scaled", [f"z{i}" for i in range(3)])
    return model.transform(li).select("l_orderkey", "l_linenumber", *[F.round(c, 8).alias(f"z{i}") for i, c in enumerate(cols)])


@query(
    "scale_zscore",
    sql="WITH s AS (SELECT "
    + ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(["o_totalprice", "o_custkey"]))
    + " FROM orders) SELECT o_orderkey, "
    + ", ".join(f"round(({c} - m{i}) / s{i}, 8) AS z{i}" for i, c in enumerate(["o_totalprice", "o_custkey"]))
    + " FROM orders, s",
)
def scale_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centred and scaled (``withMean=True, withStd=True``)."""
    o = load_table(spark, sf_dir, "orders")
    model = Pipeline(
        stages=[assembler(["o_totalprice", "o_custkey"], "raw"), scaler("raw", "scaled", with_mean=True)]
    ).fit(o)
    cols = vector_columns("scaled", ["z0", "z1"])
    return model.transform(o).select("o_orderkey", *[F.round(c, 8).alias(f"z{i}") for i, c in enumerate(cols)])


# --- G10 / G11: feature pipeline ------------------------------------------------------------------------------------
@query(
    "pipeline_features",
    sql=f"""
WITH {rank_sql('customer', 'c_mktsegment', 'r')}
SELECT c_custkey, c_acctbal AS f0, CAST(c_nationkey AS DOUBLE) AS f1, {one_hot_sql('r.idx', 4, 'f_seg')}
FROM customer JOIN r ON c_mktsegment = r.lvl
""",
)
def pipeline_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature-only pipeline: index -> one-hot -> assemble, fitted once and applied."""
    c = load_table(spark, sf_dir, "customer")
    spec = FeatureSpec(numeric=["c_acctbal", "c_nationkey"], one_hot=["c_mktsegment"])
    model = Pipeline(stages=feature_stages(spec)).fit(c)
    names = ["f0", "f1"] + [f"f_seg{j}" for j in range(4)]
    return model.transform(c).select("c_custkey", *vector_columns("features", names))
