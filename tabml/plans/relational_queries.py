"""Relational queries: sources (A*), projections and filters (B*), aggregates (D*), ordering and samples (F*),
scalar functions (H*).  All are exact (E) against DuckDB."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions import NUMERIC_TEXT_PATTERN, band, parse_duration, ratio, safe_double, time_parts
from tabml.operators import relational as R
from tabml.operators.split import with_split_column
from tabml.plans.catalog import query
from tabml.plans.sqlgen import EDGE_70, hashed_sql, unit_sql
from tabml.session import scratch_dir
from tabml.sources import TABLES, load_table, read_csv_inferred, read_csv_schema, write_csv

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


_STAGED: dict[tuple, str] = {}


def _orders_csv(spark: SparkSession, sf_dir: str, header_names: list[str] | None = None) -> str:
    """Stage the orders table as CSV in the shared scratch folder (the fixture folder is read-only and holds
    parquet); staged once per session, folder and header."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(header_names or ()))
    if key not in _STAGED:
        df = load_table(spark, sf_dir, "orders")
        if header_names:
            df = df.toDF(*header_names)
        _STAGED[key] = write_csv(df, scratch_dir(spark, "csv"))
    return _STAGED[key]


# --- A01 / A02: CSV sources ----------------------------------------------------------------------------------
@query("scan_csv_inferred", sql=f"SELECT {ORDERS_COLS} FROM orders")
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with header and inferred types.  Inference narrows keys to INT and reads dates as session-zone
    timestamps, so the declared types are restored on output."""
    df = read_csv_inferred(spark, _orders_csv(spark, sf_dir))
    return df.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        F.col("o_orderstatus").cast("string").alias("o_orderstatus"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        F.col("o_orderpriority").cast("string").alias("o_orderpriority"),
    )


@query("scan_csv_schema", sql=f"SELECT {ORDERS_COLS} FROM orders")
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a fixed schema.  The file's header carries other names on purpose: fields bind by position."""
    path = _orders_csv(spark, sf_dir, header_names=[f"col{i}" for i in range(6)])
    return read_csv_schema(spark, path, ORDERS_SCHEMA)


# --- A03 / A04 / A08 -------------------------------------------------------------------------------------------
@query("preview_n", sql=f"SELECT {ORDERS_COLS} FROM orders ORDER BY o_orderkey LIMIT 20")
def preview_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.ordered_limit(load_table(spark, sf_dir, "orders"), ["o_orderkey"], 20)


_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)


@query(
    "schema_report",
    sql=f"""
SELECT table_name, CAST(ordinal_position AS INTEGER) AS ordinal, column_name, data_type
FROM information_schema.columns WHERE table_name IN ({_TABLE_LIST})
""",
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table, ordinal, column, SQL type) for every fixture table, read from the parquet footers."""
    rows = []
    for t in TABLES:
        for ordinal, name, typ in R.schema_rows(load_table(spark, sf_dir, t)):
            rows.append((t, ordinal, name, typ))
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string")


@query(
    "cached_reuse",
    sql="""
WITH c AS (SELECT l_returnflag, l_quantity * (1 - l_discount) AS q FROM lineitem WHERE l_quantity > 5)
SELECT l_returnflag AS grp, count(*) AS n, round(sum(q), 4) AS sum_q FROM c GROUP BY l_returnflag
UNION ALL
SELECT 'ALL' AS grp, count(*) AS n, round(sum(q), 4) AS sum_q FROM c
""",
)
def cached_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cleaned frame read by two aggregates is persisted once (spilling to disk if needed), both results are
    computed, and the cache is released; only the small result rows stay."""
    cleaned = (
        load_table(spark, sf_dir, "lineitem")
        .filter(F.col("l_quantity") > 5)
        .select("l_returnflag", (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("q"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        by_flag = cleaned.groupBy(F.col("l_returnflag").alias("grp")).agg(
            F.count("*").alias("n"), F.round(F.sum("q"), 4).alias("sum_q")
        )
        total = cleaned.agg(F.lit("ALL").alias("grp"), F.count("*").alias("n"), F.round(F.sum("q"), 4).alias("sum_q"))
        rows = by_flag.unionByName(total).collect()  # bounded: one row per flag + 1
    finally:
        cleaned.unpersist()
    return spark.createDataFrame(rows, "grp string, n bigint, sum_q double")


# --- B01-B13: projections and filters ----------------------------------------------------------------------------
@query("project_columns", sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")


@query("drop_columns", sql="SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent names are ignored, as ``DataFrame.drop`` does (``strict=True`` would raise)."""
    return R.drop_columns(load_table(spark, sf_dir, "part"), ["p_name", "p_not_a_column"])


@query(
    "derive_columns",
    sql="""
SELECT c_custkey, c_acctbal + 100.0 AS c_acctbal, CAST(length(c_name) AS INTEGER) AS c_name_len,
       c_mktsegment = 'BUILDING' AS is_building
FROM customer
""",
)
def derive_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``withColumns``: replace a column, add computed ones."""
    c = load_table(spark, sf_dir, "customer")
    out = c.withColumns(
        {
            "c_acctbal": F.col("c_acctbal") + 100.0,
            "c_name_len": F.length("c_name"),
            "is_building": F.col("c_mktsegment") == "BUILDING",
        }
    )
    return out.select("c_custkey", "c_acctbal", "c_name_len", "is_building")


def _customer_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixtures have no NULLs; inject some with ``nullif``."""
    c = load_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
        F.expr("nullif(c_nationkey, 0)").alias("nation"),
        "c_acctbal",
    )


_NULLS_SQL = """
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, nullif(c_nationkey, 0) AS nation, c_acctbal
FROM customer"""


@query("drop_nulls", sql=f"SELECT * FROM ({_NULLS_SQL}) WHERE segment IS NOT NULL AND nation IS NOT NULL")
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.drop_nulls(_customer_with_nulls(spark, sf_dir))


@query("filter_not_null", sql=f"SELECT c_custkey, segment FROM ({_NULLS_SQL}) WHERE segment IS NOT NULL")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.not_null(_customer_with_nulls(spark, sf_dir), ["segment", "c_custkey"]).select("c_custkey", "segment")


@query(
    "filter_range",
    sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_quantity >= 10 AND l_quantity <= 40 AND l_discount > 0.02 AND l_tax < 0.07
""",
)
def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    cond = R.between("l_quantity", 10, 40) & (F.col("l_discount") > 0.02) & (F.col("l_tax") < 0.07)
    return li.filter(cond).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


@query("filter_isin", sql=f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderstatus IN ('F', 'O')")
def filter_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin(["F", "O"]))


@query(
    "topk_semi_filter",
    sql="""
WITH top AS (SELECT c_nationkey FROM customer GROUP BY c_nationkey ORDER BY count(*) DESC, c_nationkey LIMIT 5)
SELECT * FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM top)
""",
)
def topk_semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the 5 most frequent nations (ties by key), via a broadcast left-semi join."""
    return R.top_k_semi_filter(load_table(spark, sf_dir, "customer"), "c_nationkey", 5)


@query(
    "topk_semi_filter_nulls",
    sql="""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders),
top AS (SELECT priority FROM o WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 2)
SELECT o_orderkey, priority FROM o WHERE priority IN (SELECT priority FROM top)
""",
)
def topk_semi_filter_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-2 keys where NULL is the most frequent value: NULL takes no place."""
    o = load_table(spark, sf_dir, "orders")
    o = o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"))
    return R.top_k_semi_filter(o, "priority", 2).select("o_orderkey", "priority")


@query(
    "filter_sql_string",
    sql="SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem "
    "WHERE l_returnflag = 'R' AND l_linestatus = 'F'",
)
def filter_sql_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    return li.filter("l_returnflag = 'R' AND l_linestatus = 'F'").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )


@query("filter_col_equal", sql="SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax = l_discount")
def filter_col_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_tax") == F.col("l_discount")).select("l_orderkey", "l_linenumber", "l_tax")


@query("filter_rlike", sql="SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue) ')")
def filter_rlike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "part").filter(F.col("p_name").rlike("^(red|blue) ")).select("p_partkey", "p_name")


@query(
    "trim_outliers",
    sql="""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > 5000 AND o_totalprice < 450000 AND o_orderstatus IN ('F', 'O')
  AND month(o_orderdate) BETWEEN 2 AND 11
""",
)
def trim_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compound business filter (price band, status set, month window) — one Filter node, pushed to the scan
    where the predicate allows it."""
    o = load_table(spark, sf_dir, "orders")
    cond = (
        (F.col("o_totalprice") > 5000)
        & (F.col("o_totalprice") < 450000)
        & F.col("o_orderstatus").isin("F", "O")
        & F.month("o_orderdate").between(2, 11)
    )
    return o.filter(cond).select("o_orderkey", "o_totalprice")


# --- D01-D07: aggregates -------------------------------------------------------------------------------------------
@query("row_count", sql="SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.row_count(load_table(spark, sf_dir, "lineitem"))


@query("group_count", sql="SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_count(load_table(spark, sf_dir, "events"), "event_type")


@query(
    "crosstab_count",
    sql="SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def crosstab_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_count(load_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@query(
    "global_stats",
    sql="""
SELECT round(avg(o_totalprice), 4) AS mean_price, round(stddev_samp(o_totalprice), 4) AS std_price,
       min(o_totalprice) AS min_price, max(o_totalprice) AS max_price FROM orders
""",
)
def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = R.global_stats(load_table(spark, sf_dir, "orders"), "o_totalprice", prefix="price")
    return s.select(
        F.round("mean_price", 4).alias("mean_price"),
        F.round("std_price", 4).alias("std_price"),
        "min_price",
        "max_price",
    )


@query(
    "group_means",
    sql="""
SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price,
       round(avg(l_discount), 8) AS avg_disc, round(avg(l_tax), 8) AS avg_tax
FROM lineitem GROUP BY l_returnflag
""",
)
def group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = R.group_means(
        load_table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ["avg_qty", "avg_price", "avg_disc", "avg_tax"],
    )
    return g.select(
        "l_returnflag",
        F.round("avg_qty", 6).alias("avg_qty"),
        F.round("avg_price", 4).alias("avg_price"),
        F.round("avg_disc", 8).alias("avg_disc"),
        F.round("avg_tax", 8).alias("avg_tax"),
    )


_BANDED_SQL = """
SELECT CASE WHEN l_quantity < 10 THEN '<10' WHEN l_quantity < 20 THEN '[10,20)' WHEN l_quantity < 30 THEN '[20,30)'
            WHEN l_quantity < 40 THEN '[30,40)' ELSE '>=40' END AS band,
       round(avg(abs(l_extendedprice - l_quantity * 1530.0)), 4) AS avg_abs_error,
       round(avg(l_extendedprice), 4) AS avg_actual, count(*) AS count
FROM lineitem GROUP BY 1
"""


@query("banded_error_report", sql=_BANDED_SQL)
def banded_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute error, mean actual and count per quantity band, for a unit-price predictor."""
    from tabml.operators.evaluate import banded_errors

    li = load_table(spark, sf_dir, "lineitem").withColumn("pred", F.col("l_quantity") * 1530.0)
    rep = banded_errors(li, band("l_quantity", [10, 20, 30, 40]), "l_extendedprice", "pred")
    return rep.select(
        "band",
        F.round("avg_abs_error", 4).alias("avg_abs_error"),
        F.round("avg_actual", 4).alias("avg_actual"),
        "count",
    )


_NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_numeric",
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"
        for c in _NUM_COLS
    ),
)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = R.describe_numeric(load_table(spark, sf_dir, "lineitem"), _NUM_COLS)
    return d.select(
        "column", "count", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"), "min", "max"
    )


@query(
    "describe_string",
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, min({c}) AS min, max({c}) AS max FROM customer"
        for c in ["c_name", "c_mktsegment"]
    ),
)
def describe_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.describe_string(load_table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])


# --- F01-F08: ordering, limits, samples, splits ------------------------------------------------------------------
@query("sort_single", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def sort_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query(
    "sort_multi",
    sql="SELECT l_linestatus, l_returnflag, count(*) AS count FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2",
)
def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_count(load_table(spark, sf_dir, "lineitem"), "l_linestatus", "l_returnflag").orderBy(
        "l_linestatus", "l_returnflag"
    )


@query(
    "topk_groups",
    sql="SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY count DESC, user_id LIMIT 10",
)
def topk_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_k_groups(load_table(spark, sf_dir, "events"), "user_id", 10)


@query("limit_rows", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered limit (a bare ``limit`` keeps whichever rows arrive first)."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.ordered_limit(o, ["o_orderkey"], 1000)


@query(
    "topn_report",
    sql="SELECT c_nationkey, count(*) AS count FROM customer GROUP BY 1 ORDER BY count DESC, c_nationkey LIMIT 10",
)
def topn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_k_groups(load_table(spark, sf_dir, "customer"), "c_nationkey", 10)


@query(
    "random_sample_n",
    sql=f"SELECT o_orderkey, o_totalprice FROM {hashed_sql('orders', [('o_orderkey', 'bigint')])} ORDER BY _h, o_orderkey LIMIT 10",
)
def random_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 rows in a repeatable random order (hash of key and seed)."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.hash_sample(o, ["o_orderkey"], 10, seed=42)


@query(
    "split_hash_counts",
    sql=f"""
WITH b AS (SELECT o_orderkey, {unit_sql('_h')} AS u FROM {hashed_sql('orders', [('o_orderkey', 'bigint')])})
SELECT CASE WHEN u < {EDGE_70} THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM b GROUP BY 1
""",
)
def split_hash_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """70/30 hash split of orders: part sizes and key sums (the parts partition the table), in one pass."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey")
    parts = with_split_column(o, ["o_orderkey"], (0.7, 0.3), seed=42, names=("train", "test"))
    return parts.groupBy("split").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "split_small_holdout",
    sql=f"""
WITH b AS (SELECT l_orderkey, l_linenumber, {unit_sql('_h')} AS u
           FROM {hashed_sql('lineitem', [('l_orderkey', 'bigint'), ('l_linenumber', 'int')])})
SELECT CASE WHEN u < {round(0.9999 * (1 << 32))} THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM b GROUP BY 1
""",
)
def split_small_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hold-out of one row in 10,000: the split grid is the whole 32-bit hash, so small weights are not rounded away."""
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    parts = with_split_column(li, ["l_orderkey", "l_linenumber"], (0.9999, 0.0001), seed=42)
    return parts.groupBy("split").agg(F.count("*").alias("n"))


@query(
    "describe_mixed",
    sql="""
SELECT 'event_type' AS column, count(event_type) AS count, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev,
       min(event_type) AS min, max(event_type) AS max FROM events
UNION ALL
SELECT 'user_id', count(user_id), round(avg(user_id), 6), round(stddev_samp(user_id), 6),
       CAST(min(user_id) AS VARCHAR), CAST(max(user_id) AS VARCHAR) FROM events
""",
)
def describe_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of text and numeric columns together (B and D rows of the survey in one report)."""
    prof = R.describe_mixed(load_table(spark, sf_dir, "events"), ["event_type", "user_id"])
    return prof.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@query("split_random")
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's ``randomSplit`` 80/20 (seed 42): part sizes.  Repeatable only for the same partitioning."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = o.randomSplit([0.8, 0.2], seed=42)
    return train.agg(F.lit("train").alias("split"), F.count("*").alias("n")).unionByName(
        test.agg(F.lit("test").alias("split"), F.count("*").alias("n"))
    )


# --- H01-H13: scalar functions ---------------------------------------------------------------------------------------
_DURATION_SQL = """
SELECT event_id, txt AS duration_text,
       coalesce(TRY_CAST(substring(txt, 10, 2) AS INTEGER) * 3600 + TRY_CAST(substring(txt, 13, 2) AS INTEGER) * 60
                + TRY_CAST(substring(txt, 16, 2) AS INTEGER), 0) AS duration_sec
FROM (SELECT event_id,
             CASE event_type WHEN 'error' THEN 'bad' WHEN 'view' THEN NULL
                  WHEN 'signup' THEN '0 days ' || strftime(ts, '%H:%M:%S')
                  ELSE '000 days ' || strftime(ts, '%H:%M:%S') END AS txt
      FROM events)
"""


@query("parse_duration", sql=_DURATION_SQL)
def parse_duration_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duration text (built from event times: well-formed, short prefix, junk, NULL) to seconds."""
    ev = load_table(spark, sf_dir, "events")
    hms = F.date_format("ts", "HH:mm:ss")
    txt = (
        F.when(F.col("event_type") == "error", F.lit("bad"))
        .when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .when(F.col("event_type") == "signup", F.concat(F.lit("0 days "), hms))
        .otherwise(F.concat(F.lit("000 days "), hms))
    )
    return ev.select("event_id", txt.alias("duration_text")).withColumn("duration_sec", parse_duration("duration_text"))


@query(
    "duration_parse_report",
    sql=f"""
SELECT CASE WHEN duration_sec = 0 THEN 'zero' ELSE 'parsed' END AS outcome, count(*) AS n
FROM ({_DURATION_SQL}) GROUP BY 1
""",
)
def duration_parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many duration texts parse to 0 (bad text, other prefix width, NULL) — counted, since the cleaning
    step then drops them with ``duration_sec > 0``."""
    d = parse_duration_q(spark, sf_dir)
    return d.groupBy(F.when(F.col("duration_sec") == 0, "zero").otherwise("parsed").alias("outcome")).agg(
        F.count("*").alias("n")
    )


@query(
    "time_features",
    sql="SELECT event_id, hour(ts) AS hour, dayofweek(ts) + 1 AS day_of_week, month(ts) AS month FROM events",
)
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load_table(spark, sf_dir, "events")
    parts = time_parts("ts")
    return ev.select("event_id", *[c.cast("bigint").alias(n) for n, c in parts.items()])


@query(
    "safe_numeric_cast",
    sql="""
SELECT event_id, CASE WHEN regexp_matches(txt, '^[0-9.]+$') THEN TRY_CAST(txt AS DOUBLE) END AS value_num
FROM (SELECT event_id, CASE event_type WHEN 'error' THEN '1.2.3' WHEN 'view' THEN '.' WHEN 'signup' THEN 'n/a'
                                  ELSE CAST(value AS VARCHAR) END AS txt FROM events)
""",
)
def safe_numeric_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric text guarded by ``^[0-9.]+$`` then ``try_cast``: ``1.2.3`` and ``.`` pass the pattern but become
    NULL instead of failing the query under ANSI casts."""
    ev = load_table(spark, sf_dir, "events")
    txt = (
        F.when(F.col("event_type") == "error", F.lit("1.2.3"))
        .when(F.col("event_type") == "view", F.lit("."))
        .when(F.col("event_type") == "signup", F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
    )
    return ev.select("event_id", safe_double(txt, NUMERIC_TEXT_PATTERN).alias("value_num"))


@query(
    "age_band",
    sql="""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '<0' WHEN c_acctbal < 2500 THEN '[0,2500)'
                       WHEN c_acctbal < 5000 THEN '[2500,5000)' WHEN c_acctbal < 7500 THEN '[5000,7500)'
                       ELSE '>=7500' END AS band
FROM customer
""",
)
def age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-branch banding; labels are derived from the bounds."""
    c = load_table(spark, sf_dir, "customer")
    return c.select("c_custkey", band("c_acctbal", [0, 2500, 5000, 7500]).alias("band"))


@query(
    "band_fractional",
    sql="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.025 THEN '<0.025' WHEN l_discount < 0.05 THEN '[0.025,0.05)'
                                      WHEN l_discount < 0.075 THEN '[0.05,0.075)' ELSE '>=0.075' END AS band
FROM lineitem
""",
)
def band_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open bands with fractional bounds."""
    li = load_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", band("l_discount", [0.025, 0.05, 0.075]).alias("band"))


@query(
    "ratio_feature",
    sql="SELECT o_orderkey, CASE WHEN o_custkey = 0 THEN NULL ELSE o_totalprice / o_custkey END AS price_per_key "
    "FROM orders",
)
def ratio_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", ratio("o_totalprice", "o_custkey").alias("price_per_key"))


@query(
    "abs_error_rows",
    sql="SELECT l_orderkey, l_linenumber, abs(l_extendedprice - l_quantity * 1530.0) AS abs_error FROM lineitem",
)
def abs_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1530.0).alias("abs_error")
    )
