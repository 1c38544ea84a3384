"""Train/test splitting.

``hash_split`` (default) assigns each row by a hash of its key columns and a seed: no shuffle, no sort, the same
rows land in the same part whatever the partitioning or cluster size, and rows sharing a key stay together.
The hash is Spark's built-in Murmur3 of the seed and the keys (generated code, any key types).
``random_split`` is Spark's ``randomSplit`` (per-partition sort + Bernoulli sample); it is only repeatable for the
same input partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions import HASH_GRID as MODULUS
from tabml.functions import hash_unit


def cutoffs(weights: Sequence[float], modulus: int = MODULUS) -> list[tuple[int, int]]:
    """Half-open hash ranges ``[lo, hi)`` per weight, normalised like ``randomSplit`` does."""
    if not weights or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total = float(sum(weights))
    edges, acc = [0], 0.0
    for w in weights:
        acc += w
        edges.append(int(round(acc / total * modulus)))
    edges[-1] = modulus
    return list(zip(edges[:-1], edges[1:]))


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    u = hash_unit(keys, seed, MODULUS)
    return [df.filter((u >= lo) & (u < hi)) for lo, hi in cutoffs(weights)]


def with_split_column(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 42,
    names: Sequence[str] = ("train", "test"),
    out: str = "split",
) -> DataFrame:
    """Adds a column naming each row's part (one pass, no filter), for reports over all parts at once."""
    ranges = cutoffs(weights)
    if len(names) != len(ranges):
        raise ValueError("one name per weight")
    u = hash_unit(keys, seed, MODULUS)
    expr = None
    for (lo, hi), name in zip(ranges, names):
        cond = (u >= lo) & (u < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr)


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def split(
    df: DataFrame,
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 42,
    keys: Sequence[str] | None = None,
    mode: str = "hash",
) -> list[DataFrame]:
    if mode == "hash":
        if not keys:
            raise ValueError("hash split needs key columns")
        return hash_split(df, keys, weights, seed)
    if mode == "random":
        return random_split(df, weights, seed)
    raise ValueError(f"unknown split mode {mode!r}")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (rows, sum, xor) that tells a multiset of rows whatever their order and partitions: counts, sums and xors of
    two 64-bit hashes.  Parts of a table cover it exactly when their rows and sums add up, and their xors combine, to its own."""
    columns = list(columns or df.columns)
    a, b = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    total = [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)") for h in (a, b)]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.array(*total).alias("sums"), F.array(*[F.coalesce(F.bit_xor(h), F.lit(0)) for h in (a, b)]).alias("xors"))


def covers(parts: Sequence[DataFrame], whole: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``rows`` of the parts together, and whether they are the rows of ``whole``, each once."""
    each = None
    for part in parts:
        f = fingerprint(part, columns)
        each = f if each is None else each.unionByName(f)
    sums = [F.sum(F.col("sums")[i]).cast("decimal(38,0)") for i in (0, 1)]
    found = each.agg(F.sum("rows").alias("rows"), F.array(*sums).alias("sums"), F.array(*[F.bit_xor(F.col("xors")[i]) for i in (0, 1)]).alias("xors"))
    want = fingerprint(whole, columns).select(F.struct("*").alias("want"))
    same = F.struct("rows", "sums", "xors") == F.col("want")
    return found.crossJoin(want).select("rows", same.alias("covered"))  # one row each
