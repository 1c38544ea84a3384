
from tabml.functions import band, band_labels, hash_unit, parse_duration, ratio, safe_double


def test_parse_duration_edge_rows(spark):
    df = spark.createDataFrame(
        [("000 days 01:02:03",), ("0 days 00:05:33",), ("bad",), (None,)], "d string"
    )
    got = [r[0] for r in df.select(parse_duration("d")).collect()]
    assert got == [3723, 0, 0, 0]


def test_parse_duration_custom_offsets(spark):
    df = spark.createDataFrame([("0 days 00:05:33",)], "d string")
    assert df.select(parse_duration("d", offsets=(8, 11, 14))).first()[0] == 333


def test_safe_double(spark):
    df = spark.createDataFrame([("12",), ("1.2.3",), (".",), ("abc",), (None,)], "t string")
    guarded = [r[0] for r in df.select(safe_double("t", "^[0-9.]+$")).collect()]
    assert guarded == [12.0, None, None, None, None]
    plain = [r[0] for r in df.select(safe_double("t")).collect()]
    assert plain == [12.0, None, None, None, None]


def test_band_labels_from_bounds(spark):
    assert band_labels([25, 35, 45, 55]) == ["<25", "[25,35)", "[35,45)", "[45,55)", ">=55"]
    df = spark.createDataFrame([(16,), (24,), (25,), (54,), (55,), (None,)], "age int")
    got = [r[0] for r in df.select(band("age", [25, 35, 45, 55])).collect()]
    assert got == ["<25", "<25", "[25,35)", "[45,55)", ">=55", None]


def test_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(10.0, 4.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [2.5, None, None]



def test_hash_unit_independent_of_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = {r.k: r.u for r in df.select("k", hash_unit(["k"]).alias("u")).collect()}
    b = {r.k: r.u for r in df.repartition(7).select("k", hash_unit(["k"]).alias("u")).collect()}
    assert a == b
    assert all(0 <= v < 1 << 32 for v in a.values())
    assert 0.65 < sum(v < 0.7 * (1 << 32) for v in a.values()) / 2000 < 0.75


def test_hash_matches_duckdb_twin(spark):
    import random

    import duckdb

    from tabml.functions import hash32
    from tabml.plans.sqlgen import hashed_sql, unit_sql

    rnd = random.Random(3)
    rows = [(0, 0), (-1, -1), (2**31, 2**31 - 1), (-(2**63), -(2**31)), (2**63 - 1, 7)]
    rows += [(rnd.randint(-(2**63), 2**63 - 1), rnd.randint(-(2**31), 2**31 - 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a bigint, b int")
    got = {(r.a, r.b): (r.h, r.u) for r in df.select(
        "a", "b", hash32(["a", "b"], seed=9).alias("h"), hash_unit(["a", "b"], seed=9).alias("u")).collect()}
    values = ", ".join(f"(CAST('{a}' AS BIGINT), CAST('{b}' AS INTEGER))" for a, b in rows)
    src = hashed_sql(f"(VALUES {values}) t(a, b)", [("a", "bigint"), ("b", "int")], seed=9, out="h")
    sql = f"SELECT a, b, h, {unit_sql('h')} AS u FROM {src}"
    want = {(a, b): (h, u) for a, b, h, u in duckdb.connect().execute(sql).fetchall()}
    assert got == want
