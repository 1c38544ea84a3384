import pytest

from tabml.operators.split import cutoffs, hash_split, random_split, with_split_column


def test_cutoffs_normalise():
    edge = round(0.7 * (1 << 32))
    assert cutoffs([0.7, 0.3]) == cutoffs([7, 3]) == [(0, edge), (edge, 1 << 32)]
    assert all(lo < hi for lo, hi in cutoffs([1 - 1e-9, 1e-9]))
    with pytest.raises(ValueError):
        cutoffs([])


def test_hash_split_partitions_rows_and_is_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = hash_split(df, ["k"], (0.8, 0.2), seed=42)
    tr = {r.k for r in train.collect()}
    te = {r.k for r in test.collect()}
    assert tr.isdisjoint(te) and len(tr) + len(te) == 5000
    assert 0.75 < len(tr) / 5000 < 0.85
    tr2, _ = hash_split(df.repartition(11), ["k"], (0.8, 0.2), seed=42)
    assert {r.k for r in tr2.collect()} == tr
    tr3, _ = hash_split(df, ["k"], (0.8, 0.2), seed=7)
    assert {r.k for r in tr3.collect()} != tr


def test_split_column_matches_filters(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    labelled = with_split_column(df, ["k"], (0.7, 0.3))
    train, _ = hash_split(df, ["k"], (0.7, 0.3))
    assert {r.k for r in labelled.filter("split = 'train'").collect()} == {r.k for r in train.collect()}


def test_random_split_partitions(spark):
    df = spark.range(3000)
    a, b = random_split(df, (0.8, 0.2), seed=42)
    ids_a, ids_b = {r.id for r in a.collect()}, {r.id for r in b.collect()}
    assert ids_a.isdisjoint(ids_b) and len(ids_a) + len(ids_b) == 3000


def test_random_split_repeatable_at_fixed_partitioning(spark):
    df = spark.range(3000).repartition(4, "id")
    a1, _ = random_split(df, (0.7, 0.3), seed=42)
    a2, _ = random_split(df, (0.7, 0.3), seed=42)
    assert {r.id for r in a1.collect()} == {r.id for r in a2.collect()}
