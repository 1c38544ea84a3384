"""Sources and sinks.

* ``load_table``            — parquet table by name from a folder (the fixture layout ``<dir>/<name>.parquet``).
* ``read_csv_inferred``     — CSV with header and inferred types (one extra pass over the data for inference).
* ``read_csv_schema``       — CSV with a fixed ``StructType``; fields bind by position, bad cells become NULL.
* ``write_csv``             — CSV writer used to stage CSV inputs.
* ``write_metrics``         — parquet sink for tidy metric tables, partitioned by job and run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet``, listed anew at every call, so that appended files are read.  A job
    that reads a table for several tasks loads it once and shares the DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",", sampling_ratio: float = 1.0) -> DataFrame:
    """``header=True, inferSchema=True``.  Inference costs an extra scan; on very large inputs infer from a
    sample (``sampling_ratio`` < 1) or, better, use a fixed schema."""
    return spark.read.csv(path, header=True, inferSchema=True, sep=sep, samplingRatio=sampling_ratio)


def read_csv_schema(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Fixed schema: no inference pass.  Header names are ignored (binding is positional) and, in the default
    PERMISSIVE mode, a cell that does not parse as its field type becomes NULL."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("sep", sep)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_metrics(df: DataFrame, path: str, run_id: str | None = None) -> str:
    """Parquet sink for metric tables (job, task, split, metric, value), with ``run_id`` and ``written_at`` added.

    A run's partition is replaced, never appended to: writing the same run again (a retry) doubles no row, other runs
    stay.  Without ``run_id`` a new one is made."""
    named = df.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex)).withColumn("written_at", F.current_timestamp())
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job", "run_id").parquet(path)
    return path


# The trip table layout read with an explicit schema (11 fields, in file order).
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("Index", T.IntegerType()),
        T.StructField("Trip_Id", T.IntegerType()),
        T.StructField("User_Id", T.IntegerType()),
        T.StructField("Sex", T.StringType()),
        T.StructField("Birth_year", T.IntegerType()),
        T.StructField("Trip_start", T.TimestampType()),
        T.StructField("Trip_end", T.TimestampType()),
        T.StructField("Origin_Id", T.IntegerType()),
        T.StructField("Destination_Id", T.IntegerType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Duration", T.StringType()),
    ]
)
