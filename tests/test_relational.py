import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.operators import relational as R
from tabml.sources import read_csv_schema
from tests.conftest import SF_SMALL


def test_null_drop_any_column(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (4, "d")], "k int, v string")
    assert [r.k for r in R.drop_nulls(df).collect()] == [1, 4]


def test_drop_columns_strict(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert R.drop_columns(df, ["b", "zz"]).columns == ["a"]
    with pytest.raises(KeyError):
        R.drop_columns(df, ["zz"], strict=True)


def test_tied_top_k_ordered_by_key(spark):
    df = spark.createDataFrame([(k,) for k in [5, 5, 3, 3, 9, 9, 1]], "k int")
    assert [r.k for r in R.top_k_groups(df, "k", 2).collect()] == [3, 5]
    semi = R.top_k_semi_filter(df, "k", 2)
    assert sorted(r.k for r in semi.collect()) == [3, 3, 5, 5]


def test_csv_fixed_schema_binds_by_position_and_nulls_bad_cells(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("wrong_a,wrong_b\n1,2024-01-01 10:00:00\nx,not-a-time\n3,2024-02-03 04:05:06\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("ts", T.TimestampType())])
    rows = read_csv_schema(spark, str(p), schema).collect()
    assert [r.n for r in rows] == [1, None, 3]
    assert rows[1].ts is None and rows[0].ts is not None


def test_describe_numeric_matches_builtin(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    ours = {r.column: r for r in R.describe_numeric(li, ["l_quantity", "l_tax"]).collect()}
    built = {r.summary: r for r in li.describe("l_quantity", "l_tax").collect()}
    for c in ["l_quantity", "l_tax"]:
        assert ours[c]["count"] == int(built["count"][c])
        assert ours[c].mean == pytest.approx(float(built["mean"][c]))
        assert ours[c].stddev == pytest.approx(float(built["stddev"][c]))
        assert ours[c].min == float(built["min"][c]) and ours[c].max == float(built["max"][c])


def test_hash_sample_is_repeatable(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = [r.k for r in R.hash_sample(df, ["k"], 10).collect()]
    b = [r.k for r in R.hash_sample(df.repartition(5), ["k"], 10).collect()]
    assert a == b and len(set(a)) == 10


def test_schema_rows_types(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], "a bigint, b string, c double")
    assert R.schema_rows(df) == [(1, "a", "BIGINT"), (2, "b", "VARCHAR"), (3, "c", "DOUBLE")]


def test_csv_inference_narrows_keys_and_query_restores_types(spark):
    import __spark_entry__ as E

    df = E.queries()["scan_csv_inferred"](spark, SF_SMALL)
    types = dict(df.dtypes)
    assert types["o_orderkey"] == "bigint" and types["o_orderdate"] == "timestamp_ntz"
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()


def test_sql_string_filter_equals_column_filter(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    a = li.filter("l_returnflag = 'R' AND l_linestatus = 'F'").count()
    b = li.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).count()
    assert a == b > 0


def test_trip_csv_with_fixed_schema_then_duration_and_filters(spark, tmp_path):
    from tabml.functions import parse_duration, time_parts
    from tabml.sources import TRIP_SCHEMA

    p = tmp_path / "trips.csv"
    p.write_text(
        "Index,Trip_Id,User_Id,Sex,Birth_year,Trip_start,Trip_end,Origin_Id,Destination_Id,Age,Duration\n"
        "1,10,100,M,1990,2024-01-01 08:00:00,2024-01-01 08:12:03,5,6,34,000 days 00:12:03\n"
        "2,11,101,F,1960,2024-01-02 17:30:00,2024-01-02 17:31:00,5,7,x,000 days 00:01:00\n"
        "3,12,102,F,2001,2024-01-03 23:00:00,2024-01-03 23:05:00,6,5,23,0 days 00:05:00\n"
    )
    df = read_csv_schema(spark, str(p), TRIP_SCHEMA)
    df = df.withColumn("Duration_sec", parse_duration("Duration")).withColumns(time_parts("Trip_start"))
    rows = {r.Index: r for r in df.collect()}
    assert rows[1].Duration_sec == 723 and rows[1].hour == 8 and rows[2].Age is None
    assert rows[3].Duration_sec == 0  # other prefix width -> 0, then removed by the > 0 filter
    clean = df.filter(R.between("Age", 16, 80) & (F.col("Duration_sec") > 0) & F.col("Sex").isin("M", "F"))
    assert [r.Index for r in clean.collect()] == [1]


def test_names_with_spaces_digits_and_dots(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, "a"), (3.0, 4.0, 5.0, "b")], "`Total Volume` double, `4046` double, `a.b` double, t string")
    d = {r.column: r for r in R.describe_numeric(df, ["Total Volume", "4046", "a.b"]).collect()}
    assert d["a.b"].mean == 4.0 and d["4046"].max == 4.0 and d["Total Volume"]["count"] == 2
    g = {r.t: r for r in R.group_means(df, "t", ["a.b", "4046"], ["m_ab", "m_4046"]).collect()}
    assert g["a"].m_ab == 3.0 and g["b"].m_4046 == 4.0
    assert R.not_null(df, ["a.b"]).count() == 2
    assert R.global_stats(df, "Total Volume", prefix="tv").first().mean_tv == 2.0
