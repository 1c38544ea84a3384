"""Training-corpus pipeline over ``documents``: quality rules, line dedup, SimHash near-dedup, secret scans, packing.

Each stage is written as Parquet and reread as the next one's ``docs``; all but the last return the columns of
``documents``.  Decisions take effect: rejected documents go, common lines go from the texts, one document of each
near-duplicate group stays, live-looking secrets are masked, and what remains is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm._common import small_batches, table
from tabml.llm.line_dedup import drop_common_lines
from tabml.llm.packing import pack_documents
from tabml.llm.quality import keep_good
from tabml.llm.queries import END_ID, SEQUENCE_TOKENS, tokenizer_path
from tabml.llm.secrets import redact_secrets
from tabml.llm.simhash import keep_one_of_each
from tabml.session import scratch_dir


#: Chunks whose ids a packing worker keeps in each generation: fewer than by itself, as the stages share their executors.
KEPT_WORDS = 100_000


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` of the texts as they are now."""
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast("bigint"))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(drop_common_lines(docs, min_docs=10, min_chars=1), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_one_of_each(docs, shingle_words=4, max_bits=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _recounted(redact_secrets(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack_documents(docs, tokenizer_path(), end_id=END_ID, capacity=SEQUENCE_TOKENS, kept_words=KEPT_WORDS).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: The learned list, the components and the packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to ``documents``, each on all that its predecessor kept, written in the shared folder between."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
