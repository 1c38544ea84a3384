"""Queries of the operators that keep their result at any size: large ordered limits, heavy groups, wide category
indexes, covering splits and the exact area under the curve as a plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.evaluate import roc_area
from tabml.operators.features import index_by_table, level_table
from tabml.operators.ranking import global_rank, heavy_groups, large_limit
from tabml.operators.split import covers, hash_split, random_split
from tabml.plans.catalog import query
from tabml.plans.evaluate_queries import BINARY_SQL, binary_frame
from tabml.plans.feature_queries import rank_sql
from tabml.session import ensure_checkpoint_dir
from tabml.sources import load_table


@query("limit_rows_100k", sql="SELECT l_extendedprice, l_orderkey, l_linenumber FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT 100000")
def limit_rows_100k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering analyses' limit of 100,000 rows, ordered."""
    order = ["l_extendedprice", "l_orderkey", "l_linenumber"]
    return large_limit(load_table(spark, sf_dir, "lineitem").select(*order), order, 100_000)


@query("limit_rows_ties", sql="SELECT l_quantity, l_orderkey, l_linenumber FROM lineitem ORDER BY l_quantity, l_orderkey, l_linenumber LIMIT 20000")
def limit_rows_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large limit whose leading column has a few hot values: the cut goes on in the next column."""
    order = ["l_quantity", "l_orderkey", "l_linenumber"]
    return large_limit(load_table(spark, sf_dir, "lineitem").select(*order), order, 20_000)


@query("topk_groups_sketch", sql="SELECT event_type, count(*) AS count, true AS proven FROM events GROUP BY event_type ORDER BY count DESC, event_type LIMIT 3")
def topk_groups_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heavy groups proven by the sketch's bound."""
    top, proven = heavy_groups(load_table(spark, sf_dir, "events"), "event_type", 3)
    return top.withColumn("proven", F.lit(proven))


@query("topk_groups_flat", sql="SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey ORDER BY count DESC, l_partkey LIMIT 10")
def topk_groups_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many keys of nearly equal counts: whether or not the bound proves the candidates, the counts are exact."""
    return heavy_groups(load_table(spark, sf_dir, "lineitem"), "l_partkey", 10, tracked=64)[0]


@query("global_rank", sql="SELECT event_id, row_number() OVER (ORDER BY event_type, value DESC, event_id) - 1 AS rank FROM events")
def global_rank_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of all rows by an order with a hot leading value, without a single sorting task."""
    ev = load_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return global_rank(ev, [F.asc("event_type"), F.desc("value"), F.asc("event_id")]).select("event_id", "rank")


_WIDE = f"WITH {rank_sql('part', 'p_name', 'r')}, {rank_sql('lineitem', 'CAST(l_partkey AS VARCHAR)', 'q')}"


@query(
    "string_index_wide",
    sql=f"""{_WIDE}
SELECT p_partkey AS id, 'p_name' AS what, r.idx AS level_index FROM part JOIN r ON p_name = r.lvl
UNION ALL SELECT l_orderkey * 10 + l_linenumber, 'l_partkey', q.idx FROM lineitem JOIN q ON CAST(l_partkey AS VARCHAR) = q.lvl""",
)
def string_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-unique text and a key column indexed by level tables; no level on the driver."""
    part = load_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("v"), F.lit("p_name").alias("what"))
    line = load_table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").cast("string").alias("v"), F.lit("l_partkey").alias("what"))
    return reduce(DataFrame.unionByName, [index_by_table(df, "v", level_table(df, "v")).select("id", "what", F.col("v_index").alias("level_index")) for df in (part, line)])


@query(
    "string_index_wide_skip",
    sql=f"WITH {rank_sql('customer', 'c_name', 'r', where='c_custkey % 3 > 0')} SELECT c_custkey, r.idx AS name_index FROM customer JOIN r ON c_name = r.lvl",
)
def string_index_wide_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels fitted on a part of the rows; rows with an unseen level are dropped."""
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    found = index_by_table(c, "c_name", level_table(c.filter("c_custkey % 3 > 0"), "c_name"), "skip")
    return found.select("c_custkey", F.col("c_name_index").alias("name_index"))


@query(
    "split_cover",
    sql="SELECT mode, partitions, count(*) AS rows, true AS covered FROM orders, (VALUES ('hash'), ('random')) m(mode), (VALUES (3), (16)) p(partitions) GROUP BY mode, partitions",
)
def split_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test parts of both split modes are the table's rows, each once, at two partitionings; a random split of
    checkpointed rows, as the runner asks for."""
    ensure_checkpoint_dir(spark)
    out = []
    for partitions in (3, 16):
        orders = load_table(spark, sf_dir, "orders").repartition(partitions).checkpoint()
        for mode, parts in (("hash", hash_split(orders, ["o_orderkey"], (0.8, 0.2))), ("random", random_split(orders, (0.8, 0.2)))):
            out.append(covers(parts, orders).select(F.lit(mode).alias("mode"), F.lit(partitions).alias("partitions"), "rows", "covered"))
    return reduce(DataFrame.unionByName, out)


@query(
    "eval_auc_plan",
    sql=f"""
WITH {BINARY_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mr FROM bf),
n AS (SELECT sum(label) AS n1, count(*) - sum(label) AS n0 FROM bf)
SELECT CAST(n1 AS BIGINT) AS n_pos, CAST(n0 AS BIGINT) AS n_neg,
       round((sum(CASE WHEN label = 1 THEN mr END) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 10) AS auc
FROM r, n GROUP BY n1, n0
""",
)
def eval_auc_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact area as one plan over seven ranges of scores."""
    return roc_area(binary_frame(spark, sf_dir), "label", "score", ranges=7).withColumn("auc", F.round("auc", 10))
