import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tabml.llm.merkle import ROW_LIMIT, merkle_manifest

FIELDS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def ascend(tree, i, x):
    siblings = []
    for level in tree[:-1]:
        start = i - i % 8
        run = level[start : start + 8]
        siblings += run[: i % 8] + run[i % 8 + 1 :]
        x, i = sha("".join(run[: i % 8] + [x] + run[i % 8 + 1 :])), i // 8
    return siblings, x


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for k in order:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {k: levels([leaf(r) for r in groups[k]]) for k in order}
    top = levels([trees[k][-1][0] for k in order])
    out = []
    for at, k in enumerate(order):
        for i, r in enumerate(groups[k]):
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            near, x = ascend(trees[k], i, leaf(changed))
            far, x = ascend(top, at, x)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], sha("".join(near + far)), x, x == top[-1][0]))
    return sorted(out, key=repr)


def result(df):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return sorted((tuple(r) for r in merkle_manifest(df, hit).collect()), key=repr)


CASES = {
    "deep, hot group, lone groups, null group": [(i, f"s{i % 3}", "en" if i % 5 else None, i, f"Text {i}\nÉ") for i in range(700)]
    + [(1000 + i, None, f"x{i:02d}", None, None if i % 2 else "A") for i in range(20)],
    "one group": [(i, "s", "en", 1, "Ab") for i in range(9)],
    "one row": [(3, None, None, None, None)],
    "repeated rows, null ids, empty and long texts": [(1, "s", "en", 1, "A")] * 3 + [(None, "s", "en", 1, "B"), (None, None, "", None, "")] + [(2, "s", "en", 1, "Xy" * 200_000)],
    "a group named like the top tree": [(i, "s", g, 1, "Q") for i, g in enumerate(["/", "", "=", None, "/", "é", "\U0001f600", "z", "a", "b", "c"])],
}


@pytest.mark.parametrize("name", CASES)
def test_matches_brute_force(spark, name):
    rows = CASES[name]
    assert result(spark.createDataFrame(rows, FIELDS).repartition(5)) == brute(rows)


def test_empty_table_extra_columns_and_setting(spark):
    rows = [(i, "s", "en", 1, "Ab") for i in range(20)]
    df = spark.createDataFrame([(*r, 1, b"x", "y") for r in rows], FIELDS + ", rank int, leaf binary, tree string")
    before = spark.conf.get(ROW_LIMIT)
    assert result(df) == brute(rows)
    assert spark.conf.get(ROW_LIMIT) == before
    assert merkle_manifest(df.limit(0)).count() == 0


def test_untampered_rows_verify(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, "Ab") for i in range(30)], FIELDS)
    assert all(r.verified and r.folded_root == r.root for r in merkle_manifest(df).collect())


def test_a_climb_has_no_python_and_uses_the_recursive_plan(spark):
    from tabml.llm import merkle

    rows = spark.createDataFrame([(i, "s", "en", 1, "Ab") for i in range(30)], FIELDS)
    leaves = rows.select(merkle.group_key(F.col("lang")).alias("key"), F.col("doc_id").alias("id"), merkle.leaf_digest([F.col("text")]).alias("leaf"), F.lit(None).cast("binary").alias("tampered"))
    starts, nodes, root = merkle.build_tree(leaves)
    assert len(root) == 32 and nodes.filter("p_tree IS NULL").count() == 1
    found = merkle.climb(spark, starts, nodes)
    assert found.count() == 4 and "Python" not in found._jdf.queryExecution().toString()


def test_untampered_leaves_are_folded_along_their_proof(spark):
    """A node that is not what its leaves make shows in the folded digest of every leaf above whose path it lies."""
    from tabml.llm import merkle

    rows = spark.createDataFrame([(i, "s", "en" if i < 70 else "de", 1, "Ab") for i in range(90)], FIELDS)
    leaves = rows.select(merkle.group_key(F.col("lang")).alias("key"), F.col("doc_id").alias("id"), merkle.leaf_digest([F.col("doc_id")]).alias("leaf"), F.lit(None).cast("binary").alias("tampered"))
    starts, nodes, root = merkle.build_tree(leaves)
    ends = lambda n: {r.id: r.folded and bytes(r.folded) for r in merkle.climb(spark, starts, n).selectExpr("inline(leaves)").collect()}
    assert ends(nodes) == dict.fromkeys(range(90), root)
    bad = nodes.withColumn("children", F.when((F.col("tree") == "=en") & (F.col("level") == 2) & (F.col("idx") == 0), F.reverse("children")).otherwise(F.col("children")))
    assert {i for i, x in ends(bad).items() if x != root} == set(range(64))
