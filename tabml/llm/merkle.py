"""Merkle manifest of a dataset: leaves, grouped trees of fixed fan-out, and proofs climbed by a recursive query.

1. ``leaf_digest``: one digest a row over its fields, each written as byte count and value.
2. ``build_tree``: leaves are ranked inside their group by a range sort with per-partition offsets (no group is ever in
   one task), and every ``FANOUT`` consecutive ranks become a node, level by level; the groups' tops are then the leaves
   of one more tree.  Every level is stored: a node row holds its children's digests and a link to its parent.
3. ``climb``: a recursive query goes up from the leaves.  One climbing row carries the leaves of a run (at most
   ``FANOUT`` siblings, which share every node above them); each step joins the parent's row, appends the parent's other
   children to the siblings and folds every leaf's digest, tampered or not, into the next.

DataFrame functions and SQL only.  Digests travel as 32 bytes and are hashed as hex text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabml.llm._common import ascii_lower, col, written

FANOUT = 8
#: The tree over the groups' tops; group keys are empty (null) or begin with an equals sign.
TOP = "/"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def digest(hexes: Column) -> Column:
    """Digest (32 bytes) of an array of digests, concatenated as hex text."""
    return F.unhex(F.sha2(F.array_join(F.transform(hexes, _hex), ""), 256))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of the values in order: ``-`` for null, else UTF-8 byte count, colon, value (numbers in decimal)."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def group_key(c: Column) -> Column:
    """A group's value as text that sorts nulls first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def ranked(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0) inside ``key`` by ``order`` and ``size``, the key's rows.

    A range sort deals rows by key and order, so that a hot key spreads over partitions; a row's rank is its place in
    its partition plus the key's rows in the partitions before it.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    rows = written(rows.select("*", F.spark_partition_id().alias("part"), place.alias("place")), "ranked")
    spans = rows.groupBy(key, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(key, "part", (before - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy(key)).alias("size"))
    spans = written(spans, "spans")
    return rows.join(spans, [key, "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def _parents(nodes: DataFrame, extra: list[str]) -> DataFrame:
    """One level up: (tree, idx, size, digest, *extra) -> a row for every run of ``FANOUT`` consecutive nodes."""
    run = F.array_sort(F.collect_list(F.struct("idx", "digest", *extra)))
    up = nodes.groupBy("tree", F.floor(F.col("idx") / FANOUT).cast("bigint").alias("up"), "size").agg(run.alias("run"))
    up = up.select("tree", F.col("up").alias("idx"), F.ceil(F.col("size") / FANOUT).cast("bigint").alias("size"), F.col("run.digest").alias("children"), "run")
    return up.withColumn("digest", digest(F.col("children")))


def _levels(nodes: DataFrame, stem: str, start: int) -> list[DataFrame]:
    """Every level above ``nodes`` (tree, idx, size, digest) of the trees that have more than one node, written."""
    levels, level = [], start
    while not (rest := nodes.filter("size > 1")).isEmpty():
        level += 1
        nodes = written(_parents(rest, []).drop("run").withColumn("level", F.lit(level)), f"{stem}{level}")
        levels.append(nodes)
    return levels


def build_tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame, bytes | None]:
    """(key, id, leaf, tampered) rows -> runs, parent-linked nodes, root.

    Runs: one row for every run of leaves with ``leaves`` (id, leaf, tampered by place), the run's own node and its
    group's ``subroot``.  Nodes: (tree, level, idx, children, digest) and the parent's tree, level, idx and this node's
    place there (null above the root).  A group of one leaf has that leaf as its top.  No leaves: root None.
    """
    placed = ranked(leaves, "key", ["id", "leaf"])
    base = placed.select(F.col("key").alias("tree"), F.col("rank").alias("idx"), "size", F.col("leaf").alias("digest"), "id", "tampered")
    base = written(base, "leaves")
    runs = written(_parents(base, ["id", "tampered"]).withColumn("single", (F.col("size") == 1) & (F.size("children") == 1)), "runs")
    # a lone leaf is its group's top: no node stands above it
    first = runs.withColumn("lone", F.col("single")).select("tree", "idx", "size", F.when(F.col("lone"), F.col("children")[0]).otherwise(F.col("digest")).alias("digest"), "children", F.when(F.col("lone"), 0).otherwise(1).alias("level"))
    inner = [first.filter("level = 1"), *_levels(first.filter("level = 1").drop("children"), "level", 1)]
    nodes = inner[0].select("tree", "level", "idx", "size", "children", "digest")
    for more in inner[1:]:
        nodes = nodes.unionByName(more.select(*nodes.columns))
    tops = written(nodes.unionByName(first.filter("level = 0").select(*nodes.columns)).filter("size = 1").select("tree", "level", "digest"), "tops")
    crown = ranked(tops.withColumn("key", F.lit(TOP)).select("key", F.col("tree").alias("id"), F.col("digest").alias("leaf")), "key", ["id"])
    crown = written(crown.select(F.lit(TOP).alias("tree"), F.col("rank").alias("idx"), "size", F.col("leaf").alias("digest"), F.col("id").alias("of")), "crown")
    above = _levels(crown.drop("of"), "crown", 0)
    groups = crown.select(F.col("of").alias("tree"), F.col("idx").alias("top_idx"), F.col("size").alias("top_size"), F.col("digest").alias("subroot"))
    every = nodes.join(groups, "tree")
    for more in above:
        more = more.select("tree", "level", "idx", "size", "children", "digest")
        every = every.unionByName(more.select("*", F.lit(None).cast("bigint").alias("top_idx"), F.lit(None).cast("bigint").alias("top_size"), F.lit(None).cast("binary").alias("subroot")))
    nodes = written(_linked(every).select("tree", "level", "idx", "children", "digest", *LINK), "nodes")
    starts = runs.join(groups, "tree").withColumn("level", F.when(F.col("single"), 0).otherwise(1))
    starts = written(_linked(starts).select("run", "single", "children", "subroot", *LINK), "starts")
    last = (above[-1] if above else crown).filter("size = 1").select("digest").first()
    return starts, nodes, None if last is None else bytes(last.digest)


LINK = ["p_tree", "p_level", "p_idx", "p_place"]


def _linked(rows: DataFrame) -> DataFrame:
    """Rows of nodes with the link to the parent: in the own tree, from a group's top to the tree over the groups."""
    inside, leaves_group = F.col("size") > 1, (F.col("size") == 1) & (F.col("top_size") > 1)
    at = F.when(inside, F.col("idx")).when(leaves_group, F.col("top_idx"))
    return rows.select(
        "*",
        F.when(inside, F.col("tree")).when(leaves_group, F.lit(TOP)).alias("p_tree"),
        F.when(inside, F.col("level") + 1).when(leaves_group, F.lit(1)).alias("p_level"),
        F.floor(at / FANOUT).cast("bigint").alias("p_idx"),
        (at % FANOUT).cast("int").alias("p_place"),
    )


CLIMB = """
WITH RECURSIVE climb(leaves, subroot, siblings, p_tree, p_level, p_idx, p_place) AS (
  SELECT leaves, subroot, siblings, p_tree, p_level, p_idx, p_place FROM {starts}
  UNION ALL
  SELECT transform(c.leaves, l -> named_struct('id', l.id, 'leaf', l.leaf, 'beside', l.beside, 'folded',
             unhex(sha2(array_join(
                 transform(n.children, (x, i) -> lower(hex(CASE WHEN i = c.p_place THEN l.folded ELSE x END))), ''), 256)))),
         c.subroot,
         concat(c.siblings, filter(n.children, (x, i) -> i <> c.p_place)),
         n.p_tree, n.p_level, n.p_idx, n.p_place
  FROM climb c JOIN {nodes} n ON c.p_tree = n.tree AND c.p_level = n.level AND c.p_idx = n.idx
)
SELECT leaves, subroot, siblings FROM climb WHERE p_tree IS NULL
"""


def climb(spark: SparkSession, starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Runs at the root: ``leaves`` (id, leaf, siblings beside it in the run, folded digest), ``siblings`` above.

    Every leaf is folded with its siblings up to the root: from its tampered digest if it has one, else from its own.
    Spark bounds the rows of a recursive query by a session setting; it is lifted while the climb is written.
    """
    own = lambda x, i: F.struct(
        x.id.alias("id"),
        x.digest.alias("leaf"),
        F.filter("children", lambda _, j: (j != i) & ~F.col("single")).alias("beside"),
        F.when(F.col("single"), F.coalesce(x.tampered, x.digest))
        .otherwise(digest(F.transform("children", lambda y, j: F.when(j == i, F.coalesce(x.tampered, x.digest)).otherwise(y))))
        .alias("folded"),
    )
    none_yet = F.array().cast("array<binary>")
    starts = starts.select(F.transform("run", own).alias("leaves"), "subroot", none_yet.alias("siblings"), *LINK)
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return written(spark.sql(CLIMB, starts=starts, nodes=nodes), "climbed")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def merkle_manifest(
    df: DataFrame, tampered: Column | None = None, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
) -> DataFrame:
    """One row per row of ``df``: id, ``leaf, subroot, root, proof_sha256, folded_root, verified`` (digests as hex text).

    Leaves ascend by id inside their group (null ids first, equal ids by digest, so that repeated rows take places side
    by side); a null group is a group of its own, before all others.  Where ``tampered`` holds, ``folded_root`` is
    recomputed from the row with A-Z of its text lower-cased (a null text stays) and the original siblings, else from
    the original leaf.  Texts of any length are hashed in the scan and not shuffled; null fields count as ``-``; an empty
    table gives no row; columns beside ``fields`` are not looked at.  Groups of any size are split over tasks.
    """
    changed = ascii_lower(col(text_col))
    leaf = leaf_digest([col(f) for f in fields])
    other = leaf_digest([changed if f == text_col else col(f) for f in fields])
    leaves = df.select(group_key(col(group_col)).alias("key"), col(id_col).alias("id"), leaf.alias("leaf"), F.when(F.lit(False) if tampered is None else tampered, other).alias("tampered"))
    starts, nodes, root = build_tree(written(leaves, "digests"))  # written: the range sort samples its input first
    found = climb(df.sparkSession, starts, nodes)
    root = F.lit(root).cast("binary")
    rows = found.select("siblings", "subroot", F.explode("leaves").alias("x"))
    proof = F.sha2(F.array_join(F.transform(F.concat("x.beside", "siblings"), _hex), ""), 256)
    folded = F.col("x.folded")
    return rows.select(
        F.col("x.id").alias(id_col), _hex(F.col("x.leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(root).alias("root"),
        proof.alias("proof_sha256"), _hex(folded).alias("folded_root"), (folded == root).alias("verified"),
    )
