"""Global ranks, large ordered limits and heavy groups without a single merging task.

* ``global_rank``: a range sort deals the rows; a row's rank is its place in its partition plus the rows before it.
* ``large_limit``: the first n rows of an order by a threshold from a mergeable quantile sketch; only rows up to it are
  sorted.  Ties at the threshold go on with the next column of the order, so a hot value costs no more than a rare one.
* ``heavy_groups``: the most frequent keys from a mergeable frequent-items sketch, counted exactly, with the sketch's bound
  as the proof that no other key can be among them; if the proof fails, all keys are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.operators.relational import col, top_k_groups
from tabml.session import ensure_checkpoint_dir

#: Rank error of the quantile sketch is 1 / ACCURACY of the rows.
ACCURACY = 10_000


def global_rank(df: DataFrame, order: Sequence[Column | str], out: str = "rank") -> DataFrame:
    """``df`` with ranks from 0 by a total order, as a checkpointed table; the rows are dealt by ranges of the order."""
    ensure_checkpoint_dir(df.sparkSession)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")).checkpoint()  # ranges are sampled: dealt once
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each partition
    return rows.join(sizes.select("_part", before.alias("_before")), "_part").withColumn(out, F.col("_place") + F.col("_before")).drop("_part", "_place", "_before")


def _sketchable(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType) and not isinstance(t, T.DecimalType)


def large_limit(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (names, ascending, NULL first), as ``orderBy(*order).limit(n)`` gives them.

    A numeric leading column is cut at a sketched quantile: one aggregate finds the threshold, one proves it, and the final
    sort reads about ``n`` rows instead of ``n`` of every partition.  Any other leading column takes the plain limit."""
    if not order or n <= 0 or not _sketchable(df.schema[order[0]].dataType):
        return df.orderBy(*[col(c) for c in order]).limit(n)
    x = col(order[0])
    is_nan = F.isnan(x) if isinstance(df.schema[order[0]].dataType, T.FractionalType) else F.lit(False)  # sorts last, as the largest
    rows, nulls = df.agg(F.count(F.lit(1)), F.count_if(x.isNull())).first()
    if n >= rows:
        return df
    if n <= nulls:
        return large_limit(df.filter(x.isNull()), order[1:], n) if len(order) > 1 else df.filter(x.isNull()).limit(n)
    values, wanted = df.filter(x.isNotNull()), n - nulls
    slack = 2.0 / ACCURACY
    while True:
        share = min(1.0, wanted / (rows - nulls) + slack)
        cut = values.agg(F.percentile_approx(F.when(~is_nan, x), share, ACCURACY)).first()[0]
        if cut is None or share >= 1.0:
            return df.orderBy(*[col(c) for c in order]).limit(n)
        below, equal = values.agg(F.count_if((x < cut) & ~is_nan), F.count_if(x == cut)).first()
        if below + equal >= wanted:
            break
        slack *= 8
    first = df.filter(x.isNull() | ((x < cut) & ~is_nan))
    if below >= wanted:
        return first.orderBy(*[col(c) for c in order]).limit(n)
    ties = df.filter(x == cut)
    rest = large_limit(ties, order[1:], wanted - below) if len(order) > 1 else ties.limit(wanted - below)
    return first.unionByName(rest)


def _sketch_error(tracked: int) -> float:
    """Largest share of the rows that a key can have without being among the sketch's items: items are returned when their
    lower bound is above the error, and a map of m slots errs by at most 3.5 / m of the rows."""
    slots = 1 << max(3, (int(tracked / 0.75)).bit_length() - 1)
    return 2 * 3.5 / slots


def heavy_groups(df: DataFrame, key: str, k: int, tracked: int = 16_384) -> tuple[DataFrame, bool]:
    """The ``k`` most frequent values of ``key`` with their counts (NULL counts as a value; ties by value), and whether the
    sketch proved them.

    Each partition ships a sketch of at most ``tracked`` items instead of its distinct keys; the candidates are counted
    exactly by a second pass.  A key beyond the candidates has at most the sketch's error in rows, so the ranking is proven
    when the k-th count is above it; otherwise every key is counted as by ``top_k_groups``."""
    spark, c = df.sparkSession, col(key)
    some = max(k, 1)
    name = "`" + key.replace("`", "``") + "`"
    head = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(c.isNull()).alias("nulls"), F.expr(f"approx_top_k({name}, {max(some, tracked)}, {max(some, tracked)}) FILTER (WHERE {name} IS NOT NULL)").alias("top"))
    r = head.first()
    candidates = spark.createDataFrame([(x["item"],) for x in r.top or []], T.StructType([T.StructField(key, df.schema[key].dataType)]))
    counts = df.join(candidates, key, "left_semi").groupBy(c).agg(F.count("*").alias("count"))
    if r.nulls:
        counts = counts.unionByName(spark.createDataFrame([(None, r.nulls)], counts.schema))
    best = counts.orderBy(F.desc("count"), F.asc(key)).limit(k).collect()  # k rows
    kth = best[-1]["count"] if len(best) == k and best else 0
    if kth > _sketch_error(max(some, tracked)) * r.n:
        return spark.createDataFrame(best, counts.schema), True
    return top_k_groups(df, key, k), False
