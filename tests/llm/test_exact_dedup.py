import hashlib
import os
import random

from tabml.llm.exact_dedup import OpenTable, exact_duplicates, grace, normalised


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i))
    out = {}
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_matches_brute_force_with_edge_texts(spark, docs_of):
    texts = [None, "", " \n\t\x0b\x0c\r ", "a b", "ab", "a  b", " ", "É é", "Éé", "x" * 300_000, "x" * 300_000 + " ", "b a"] * 3 + ["hot copy"] * 60
    df = docs_of(texts)
    assert result(exact_duplicates(df)) == brute(list(enumerate(texts)))


def test_small_tables_spill_and_agree(spark, docs_of):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "b", "c"], k=rng.randint(1, 6))) for _ in range(400)]
    assert result(exact_duplicates(docs_of(texts), table_bytes=2_000)) == brute(list(enumerate(texts)))


def test_repeated_rows_null_ids_extra_columns_and_empty(spark):
    rows = [(1, "a", "x", 5), (1, "a", "x", 5), (None, "a", "x", 5), (None, None, None, 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, rid string, class_id int")
    got = sorted((r.doc_id is None, r.keep_id is None, r.group_size, r.kept) for r in exact_duplicates(df).collect())
    assert got == [(False, False, 3, False), (False, False, 3, True), (True, False, 3, False), (True, True, 1, True)]
    assert exact_duplicates(df.limit(0)).count() == 0


def test_grace_recursion_leaves_no_files(tmp_path):
    recs = [(False, i, hashlib.sha256(c).digest(), c) for i, c in enumerate([bytes([i % 50]) * 100 for i in range(500)])]
    got = dict(grace(recs, 1_000, str(tmp_path)))
    assert got == {i: i % 50 for i in range(500)} and not os.listdir(tmp_path)


def test_equal_digests_are_told_apart_by_content():
    t = OpenTable()
    assert [t.find_or_add(b"0" * 32, c, k) for k, c in enumerate([b"x", b"y", b"x"])] == [0, 1, 0]
    assert normalised("a \t b\u00a0") == "ab\u00a0".encode()
