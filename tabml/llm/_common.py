"""Helpers shared by the operators: row packing, written intermediate tables, byte-exact text expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.session import ensure_checkpoint_dir, scratch_dir

#: Fixed values of the contracts: the ASCII white space that separates words, and A-Z with its lower case.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """A column by its literal name (dots, spaces and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def pack(df: DataFrame, **named: str) -> DataFrame:
    """The input row as one struct ``row`` beside the columns an operator works on, under the operator's own names.

    Extra input columns can then never clash with an operator's working columns.
    """
    return df.select(F.struct(*[col(c).alias(c) for c in df.columns]).alias("row"), *[col(c).alias(k) for k, c in named.items()])


def unpack(df: DataFrame, columns: list[str], replace: dict[str, Column] | None = None, add: dict[str, Column] | None = None) -> DataFrame:
    """Back from ``pack``: the input columns in order (some replaced), then the added ones.

    An added column of an input column's name takes that column's place at the end.
    """
    replace, add = replace or {}, add or {}
    taken = {a.lower() for a in add}
    kept = [replace[c].alias(c) if c in replace else F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[v.alias(k) for k, v in add.items()])


def written(df: DataFrame, name: str, partition_by: str | None = None, group_bytes: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared checkpoint folder and read it again.

    ``group_bytes`` bounds the row groups of tables with large rows, as a reader holds one row group at a time."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    out = df.write.option("compression", "zstd")
    out = out.option("parquet.block.size", str(group_bytes)) if group_bytes else out
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a slim table."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def text_key(c: Column) -> Column:
    """128 bits of a text: equal texts get equal results from operators that look at the text alone."""
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))


#: Whole texts travel to Python workers in Arrow batches of at most so many rows and bytes: Spark's defaults (10,000 rows,
#: 64 MB) held in the JVM and in each worker leave little room on small executors.
ARROW_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def small_batches(spark: SparkSession) -> None:
    """Set ``ARROW_BATCHES`` for the session; the queries and the pipeline do, operators leave the session alone."""
    for key, value in ARROW_BATCHES.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, bytes]:
    """Offsets and UTF-8 bytes of a string array, nulls as empty texts."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null(""), pa.array([], pa.large_string())])
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    start = int(offsets[0])
    return offsets - start, b"" if data is None else bytes(data[start : int(offsets[-1])])


def coded_words(texts: pa.Array, byte_map: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, and the word number and text number of every word in order.

    ``byte_map`` is applied to every byte first (256 bytes, those above ASCII to themselves); then ASCII white space
    separates."""
    offsets, data = text_bytes(texts)
    clean = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.translate(byte_map))])
    lists = pc.ascii_split_whitespace(clean)
    owners, words = pc.list_parent_indices(lists), lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(real).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), owners.filter(real).to_numpy(zero_copy_only=False)


def packed(values: np.ndarray, kind: type) -> bytes:
    """A number array as zstd-compressed bytes, all lowest bytes first, then the next ones."""
    planes = np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    return pa.compress(np.ascontiguousarray(planes.T).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: pa.Scalar, kind: type, n: int) -> np.ndarray:
    """``n`` numbers of ``packed`` bytes in an Arrow binary."""
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data.as_buffer(), n * width, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).reshape(n)
