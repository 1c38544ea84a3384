"""Relational building blocks: projection, cleaning filters, profiles, group reports, ordering, top-k, samples.

All are DataFrame expressions that Catalyst optimises as a whole: filters and projections reach the parquet
scan, group reports use partial (map-side) aggregation, ordered limits run as a per-partition top-n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by its literal name: spaces, leading digits and dots (``Total Volume``, ``4046``, ``a.b``) are
    taken as part of the name, never as struct access."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_columns(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """``df.drop`` silently ignores absent names; ``strict`` raises instead."""
    if strict:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove rows with a NULL in any (or any listed) column."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = col(c).isNotNull() if cond is None else cond & col(c).isNotNull()
    return df.filter(cond) if cond is not None else df


def between(c: str, lo=None, hi=None, lo_inclusive: bool = True, hi_inclusive: bool = True) -> Column:
    x = col(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((x >= lo) if lo_inclusive else (x > lo))
    if hi is not None:
        cond = cond & ((x <= hi) if hi_inclusive else (x < hi))
    return cond


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def global_stats(df: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    p = prefix if prefix is not None else column
    x = col(column).cast("double")
    return df.agg(
        F.avg(x).alias(f"mean_{p}"),
        F.stddev_samp(x).alias(f"std_{p}"),
        F.min(x).alias(f"min_{p}"),
        F.max(x).alias(f"max_{p}"),
    )


def group_means(df: DataFrame, key: str | Column, cols: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    names = list(names) if names is not None else [f"avg_{c}" for c in cols]
    return df.groupBy(key).agg(*[F.avg(col(c).cast("double")).alias(n) for c, n in zip(cols, names)])


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Typed long profile (column, count, mean, stddev, min, max) of numeric columns, from ONE aggregate.

    ``df.describe`` returns every statistic as a string; here they stay numbers."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]
    aggs = []
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    wide = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("count"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("stddev"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*structs)))


def describe_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long profile (column, count, min, max) of text columns (mean and stddev are undefined for text)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(col(c)).alias(f"n{i}"), F.min(col(c)).alias(f"lo{i}"), F.max(col(c)).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("count"),
            F.col(f"lo{i}").cast("string").alias("min"),
            F.col(f"hi{i}").cast("string").alias("max"),
        )
        for i, c in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*structs)))


def describe_mixed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long profile (column, count, mean, stddev, min, max) of text and numeric columns together, in one aggregate.

    Minimum and maximum are text; mean and stddev are NULL for text columns."""
    text = {f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)}
    aggs, structs = [], []
    for i, c in enumerate(cols):
        x = col(c)
        mean, std = (F.lit(None).cast("double"),) * 2 if c in text else (F.avg(x), F.stddev_samp(x))
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).cast("string").alias(f"lo{i}"), F.max(x).cast("string").alias(f"hi{i}")]
        aggs += [F.first(mean).alias(f"m{i}"), F.first(std).alias(f"s{i}")] if c in text else [mean.alias(f"m{i}"), std.alias(f"s{i}")]
        named = (("count", "n"), ("mean", "m"), ("stddev", "s"), ("min", "lo"), ("max", "hi"))
        structs.append(F.struct(F.lit(c).alias("column"), *[F.col(f"{k}{i}").alias(name) for name, k in named]))
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def top_k_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys; equal counts are ordered by key so the cut is deterministic."""
    return group_count(df, key).orderBy(F.desc("count"), F.asc(key)).limit(k)


def top_k_semi_filter(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose key is among the k most frequent keys; NULL is no key and takes no place.

    The key list never visits the driver: it stays a k-row DataFrame in a left-semi join.  The planner knows its size
    (the limit) and broadcasts it under its own threshold; beyond, adaptive execution splits hot keys."""
    top = top_k_groups(df.filter(col(key).isNotNull()), key, k).select(col(key))
    return df.join(top, on=key, how="left_semi")


def ordered_limit(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows by a total order (``TakeOrderedAndProject``: top-n per partition, then merged)."""
    return df.orderBy(*order).limit(n)


def hash_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows in a repeatable pseudo-random order (hash of key and seed, ties by key), unlike
    ``orderBy(rand())``; runs as a per-partition top-n, so nothing is fully sorted."""
    from tabml.functions import hash32

    return df.orderBy(hash32(keys, seed), *keys).limit(n)


def schema_rows(df: DataFrame) -> list[tuple[int, str, str]]:
    """(ordinal, column, SQL type) for each field, types in ANSI spelling."""
    def sql_type(dt: T.DataType) -> str:
        mapping = {
            T.LongType: "BIGINT",
            T.IntegerType: "INTEGER",
            T.ShortType: "SMALLINT",
            T.ByteType: "TINYINT",
            T.DoubleType: "DOUBLE",
            T.FloatType: "FLOAT",
            T.StringType: "VARCHAR",
            T.BooleanType: "BOOLEAN",
            T.DateType: "DATE",
            T.TimestampNTZType: "TIMESTAMP",
            T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        }
        for k, v in mapping.items():
            if isinstance(dt, k):
                return v
        if isinstance(dt, T.ArrayType):
            return sql_type(dt.elementType) + "[]"
        return dt.simpleString().upper()

    return [(i + 1, f.name, sql_type(f.dataType)) for i, f in enumerate(df.schema.fields)]
