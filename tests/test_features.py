import pytest
from pyspark.ml import Pipeline

from tabml.operators.features import (
    FeatureSpec,
    feature_stages,
    index_labels,
    one_hot_encoder,
    scaler,
    string_indexer,
    vector_columns,
    assembler,
)


def test_index_order_by_frequency_then_value(spark):
    df = spark.createDataFrame([("c",), ("c",), ("b",), ("a",)], "x string")
    model = string_indexer(["x"]).fit(df)
    got = {r.x: r.x_index for r in model.transform(df).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}
    assert index_labels(model, "x") == ["c", "a", "b"]


def test_null_and_unseen_error_by_default_and_skip(spark):
    fit = spark.createDataFrame([("a",), ("b",)], "x string")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "x string")
    strict = string_indexer(["x"]).fit(fit)
    with pytest.raises(Exception):
        strict.transform(new).collect()
    skip = string_indexer(["x"], handle_invalid="skip").fit(fit)
    assert [r.x for r in skip.transform(new).collect()] == ["a"]


def test_one_hot_drops_last_level(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",)], "x string")
    model = Pipeline(stages=[string_indexer(["x"]), one_hot_encoder(["x"])]).fit(df)
    rows = model.transform(df).select("x", *vector_columns("x_encoded", ["e0", "e1"])).distinct().collect()
    got = {r.x: (r.e0, r.e1) for r in rows}
    assert got == {"a": (1.0, 0.0), "b": (0.0, 1.0), "c": (0.0, 0.0)}
    out = model.transform(df).first().x_encoded
    assert out.size == 2


def test_scaler_uses_sample_stddev(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "v double")
    model = Pipeline(stages=[assembler(["v"], "raw"), scaler("raw", "s")]).fit(df)
    vals = sorted(r.z for r in model.transform(df).select(*vector_columns("s", ["z"])).collect())
    assert vals == pytest.approx([1.0, 2.0, 3.0])  # sample stddev of 1,2,3 is 1


def test_target_never_a_feature():
    spec = FeatureSpec(numeric=["a"], one_hot=["b"])
    with pytest.raises(ValueError):
        spec.check_target("b")
    spec.check_target("c")


def test_assembler_rejects_null_by_default(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    with pytest.raises(Exception):
        Pipeline(stages=feature_stages(FeatureSpec(numeric=["v"]))).fit(df).transform(df).collect()
