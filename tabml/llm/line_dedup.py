"""Line deduplication with levelled sorted runs of line hashes (DataFrame functions only).

``LineRuns`` keeps, in the shared folder, how many documents hold each line: runs sorted by hash on levels, as in a
log-structured merge tree.  A batch of lines merge-anti-joins the settled run (lines already known to be too common
need no more counting) and adds its counts as a new run on level 0; ``fanout`` runs of a level are compacted into one
of the next, and lines that reach the threshold join the settled run, which is written anew.  Batches added later, also
by another session, go on from the same runs.

The settled run is one table in buckets of the hash, each a sorted file: the merge-anti-join reads it in its order, so
that only the batch is dealt and sorted.

A line is known by 128 bits of its key, a document by 128 bits of its text: what a text loses depends on the text
alone, so documents are joined to their lost lines by content, and no row numbers have to survive a lost executor.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm._common import ASCII_SPACE, ascii_lower, col, empty_if_null, pack, text_key, unpack, written
from tabml.session import scratch_dir

RUN = "a bigint, b bigint, n bigint"
MANIFEST = "written bigint, state string"


#: Session settings of the merge-anti-join: a scan of a bucketed table with one file a bucket says that it is sorted, and
#: the join stays above the batch's counts (below them, a hot line's rows would all meet in one task).
MERGE = {
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.optimizer.excludedRules": "org.apache.spark.sql.catalyst.optimizer.PushDownLeftSemiAntiJoin",
}


@contextmanager
def merge_settings(spark: SparkSession):
    """``MERGE`` while a batch is added; the session's own settings afterwards."""
    before = {key: spark.conf.get(key, None) for key in MERGE}
    for key, value in MERGE.items():
        own = before[key] if key.endswith("excludedRules") else None
        spark.conf.set(key, f"{own},{value}" if own else value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class LineRuns:
    """Runs of (a, b, n): line hash and number of documents, in disjoint batches of documents.

    After each batch a manifest names the levels and the settled run; an instance on the same folder goes on from the
    last one.  One instance at a time may add to a folder.  The settled run is registered in the session's catalog under
    a name of its own; ``close`` takes it out again and leaves the files.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, min_docs: int = 10, fanout: int = 4) -> None:
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder or scratch_dir(spark, "runs"), min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.settled: tuple[int, int] | None = None  # run number, buckets
        self.table = ""
        self.written = 0
        if folder:
            self._load()

    def _load(self) -> None:
        """The state of the latest manifest of the folder, if there is one."""
        try:
            found = self.spark.read.schema(MANIFEST).json(f"{self.folder}/manifest-*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        rows = [r for (r,) in found.groupBy().agg(F.max_by("state", "written")).collect() if r]
        if rows:
            state = json.loads(rows[0])
            if state["min_docs"] != self.min_docs:
                raise ValueError(f"the runs in {self.folder} were settled at {state['min_docs']} documents, not {self.min_docs}")
            self.written = state["written"]
            self.levels = [[self._path(k) for k in level] for level in state["levels"]]
            if state["settled"]:
                number, buckets = state["settled"]
                name = self._name()
                self.spark.sql(f"CREATE TABLE {name} ({RUN}) USING parquet CLUSTERED BY (a, b) SORTED BY (a, b) INTO {buckets} BUCKETS LOCATION '{self._path(number)}'")
                self.settled, self.table = (number, buckets), name

    def _save(self) -> None:
        number = lambda path: int(path.rpartition("-")[2])
        state = {"min_docs": self.min_docs, "written": self.written, "settled": self.settled, "levels": [[*map(number, level)] for level in self.levels]}
        row = self.spark.range(1).select(F.lit(self.written).cast("bigint").alias("written"), F.lit(json.dumps(state)).alias("state"))
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest-{self.written:05d}")

    def _path(self, number: int) -> str:
        return f"{self.folder}/run-{number:05d}"

    def _name(self) -> str:
        return f"tabml_settled_{uuid.uuid4().hex}"

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*paths) if paths else self.spark.createDataFrame([], RUN)

    def _write(self, run: DataFrame) -> str:
        path = self._path(self.written)
        self.written += 1
        run.sortWithinPartitions("a", "b").write.mode("overwrite").option("compression", "zstd").parquet(path)  # over what a broken batch left
        return path

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """The batch's counted lines that are not settled: a merge join that reads the settled run in its own buckets and
        order.  Lines are counted first, so that a hot one is a row a task before it is dealt."""
        if not self.settled:
            return counts
        return counts.join(self.spark.table(self.table).select("a", "b").hint("merge"), ["a", "b"], "left_anti")

    def add(self, lines: DataFrame) -> None:
        """A batch: one row (a, b) for each line and document that holds it."""
        with merge_settings(self.spark):
            self.levels[0].append(self._write(self.unsettled(lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1
        self._save()

    def _compact(self, level: int) -> None:
        if level + 1 == len(self.levels):
            self.levels.append([])
        path = self._write(self._read(self.levels[level]).groupBy("a", "b").agg(F.sum("n").alias("n")))
        self._settle(self._read([path]).filter(F.col("n") >= self.min_docs))
        self.levels[level] = []
        self.levels[level + 1].append(path)

    def _settle(self, common: DataFrame) -> None:
        """Write the settled run anew with ``common``: one sorted file a bucket."""
        if self.settled:
            common = self.spark.table(self.table).unionByName(common)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        number, name = self.written, self._name()
        self.written += 1
        run = common.groupBy("a", "b").agg(F.max("n").alias("n")).repartition(buckets, "a", "b")
        run.write.mode("overwrite").bucketBy(buckets, "a", "b").sortBy("a", "b").option("path", self._path(number)).option("compression", "zstd").format("parquet").saveAsTable(name)
        self.close()
        self.settled, self.table = (number, buckets), name

    def close(self) -> None:
        """Take the settled run's name out of the catalog; the files stay."""
        if self.table:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            self.settled, self.table = None, ""

    def common(self) -> DataFrame:
        """Distinct (a, b) of the lines found in at least ``min_docs`` documents so far, over all runs."""
        runs = self._read([p for level in self.levels for p in level])
        counted = runs.groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= self.min_docs).select("a", "b")
        return counted.unionByName(self.spark.table(self.table).select("a", "b")).distinct() if self.settled else counted


def line_keys(text: Column) -> Column:
    """The key of each line: stripped of ASCII white space, A-Z lower-cased."""
    return F.transform(F.split(ascii_lower(empty_if_null(text)), "\n", -1), lambda s: F.btrim(s, F.lit(ASCII_SPACE)))


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def drop_common_lines(df: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1, batches: int = 6, fanout: int = 3) -> DataFrame:
    """All rows of ``df`` with the text's common lines dropped; ``n_lines`` (before) and ``n_dropped`` are added.

    Texts are split at ``\\n``.  A line's key is the line stripped of ASCII white space at both ends, A-Z lower-cased;
    keys of at least ``min_chars`` code points found in at least ``min_docs`` rows (repeated rows count each) lose all
    their lines in every row; the other lines stay as they are, joined by ``\\n``.  A null or empty text is one empty
    line and becomes the empty text; a text of any length is split whole, and only its lines' hashes are dealt.  Input
    columns named like an added one are replaced.
    """
    spark = df.sparkSession
    text = empty_if_null(col(text_col))
    held = F.filter(F.array_distinct(F.transform(F.filter(line_keys(col(text_col)), lambda k: F.char_length(k) >= min_chars), key_hash)), lambda h: h.a.isNotNull())
    lines = df.select(text_key(text).alias("doc"), F.explode(held).alias("line")).select("doc", "line.a", "line.b")
    lines = written(lines.withColumn("batch", F.pmod("doc.a", F.lit(batches)).cast("int")), "lines", partition_by="batch")
    runs = LineRuns(spark, min_docs=min_docs, fanout=fanout)
    for k in range(batches):
        runs.add(lines.filter(F.col("batch") == k).select("a", "b"))
    common = written(runs.common(), "common")
    runs.close()
    hits = lines.select("doc", "a", "b").join(common, ["a", "b"])
    lost = written(hits.groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("lost")), "lost")
    keyed = pack(df, text=text_col).withColumn("text", empty_if_null(F.col("text"))).withColumn("doc", text_key(F.col("text")))
    joined = keyed.join(lost, "doc", "left")
    raw = F.split("text", "\n", -1)
    gone = F.transform(line_keys(F.col("text")), lambda k: F.array_contains("lost", key_hash(k)) & (F.char_length(k) >= min_chars))
    kept = F.filter(raw, lambda s, i: ~F.get("gone", i))
    out = joined.withColumn("gone", F.when(F.col("lost").isNotNull(), gone))
    cleaned = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    dropped = F.coalesce(F.size(F.filter("gone", lambda g: g)).cast("bigint"), F.lit(0).cast("bigint"))
    counted = out.select("row", cleaned.alias("cleaned"), F.size(raw).cast("bigint").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(dropped).cast("bigint").alias("n_dropped"))
    return unpack(counted, df.columns, replace={text_col: F.col("cleaned")}, add={"n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")})
