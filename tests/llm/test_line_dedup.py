import random

import pytest

from tabml.llm.line_dedup import LineRuns, drop_common_lines, merge_settings

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(texts, min_docs=10, min_chars=1):
    held = {}
    for t in texts:
        for k in {key(s) for s in (t or "").split("\n")}:
            held[k] = held.get(k, 0) + 1
    gone = {k for k, n in held.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        stay = [s for s in lines if key(s) not in gone]
        out.append(("\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def check(spark, docs_of, texts, **kw):
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in drop_common_lines(docs_of(texts), **kw).collect()}
    want = brute(texts, **{k: v for k, v in kw.items() if k.startswith("min")})
    assert got == dict(enumerate(want))


def test_matches_brute_force(spark, docs_of):
    rng = random.Random(7)
    lines = ["Common line.", " common LINE.\t", "\x0bCOMMON line.\r", "É", "é", "", " ", "a ", "b"] + [f"line {i}" for i in range(60)]
    texts = [None, "", "\n", "\n\n", "Common line.", "x" * 200_000] + ["\n".join(rng.choices(lines, k=rng.randint(1, 12))) for _ in range(150)] + ["one\ncopy"] * 30
    check(spark, docs_of, texts)


def test_threshold_is_exact_and_min_chars_holds(spark, docs_of):
    texts = ["nine\nten\nab\nrest %d" % i for i in range(9)] + ["ten\nab\nten\nab"]
    check(spark, docs_of, texts, min_docs=10, min_chars=3, batches=2)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, "x\nrow %d" % i, i, 2) for i in range(12)], "doc_id bigint, text string, n_lines int, a int").repartition(3)
    got = drop_common_lines(df)
    assert got.columns == ["doc_id", "text", "a", "n_lines", "n_dropped"]
    assert {(r.doc_id, r.text, r.a, r.n_lines, r.n_dropped) for r in got.collect()} == {(i, f"row {i}", 2, 2, 1) for i in range(12)}
    assert drop_common_lines(df.limit(0)).count() == 0


def test_runs_compact_over_many_batches(spark):
    runs = LineRuns(spark, min_docs=5, fanout=2)
    for _ in range(7):
        runs.add(spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "a bigint, b bigint"))
    assert sorted(tuple(r) for r in runs.common().collect()) == [(1, 1), (2, 2)]
    runs = LineRuns(spark, min_docs=8, fanout=3)
    for _ in range(7):
        runs.add(spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "a bigint, b bigint"))
    assert [tuple(r) for r in runs.common().collect()] == [(1, 1)]


def test_another_instance_goes_on_from_the_runs(spark, tmp_path):
    batch = lambda *keys: spark.createDataFrame([(k, -k) for k in keys], "a bigint, b bigint")
    folder = f"{tmp_path}/runs"
    for keys in ((1, 2), (1, 3), (1, 2), (2, 4), (4, 4)):  # a new instance for each batch
        LineRuns(spark, folder, min_docs=3, fanout=2).add(batch(*keys))
    last = LineRuns(spark, folder, min_docs=3, fanout=2)
    assert {tuple(r) for r in last.common().collect()} == {(1, -1), (2, -2), (4, -4)} and last.settled
    with pytest.raises(ValueError):
        LineRuns(spark, folder, min_docs=4)


def test_the_anti_join_merges_the_settled_run_in_its_order(spark):
    runs = LineRuns(spark, min_docs=2, fanout=2)
    batch = spark.range(4000).selectExpr("id % 50 AS a", "id % 50 AS b").repartition(3)
    runs.add(batch)
    runs.add(batch)
    assert runs.settled and spark.table(runs.table).count() == 50
    rules = "spark.sql.optimizer.excludedRules"
    before = spark.conf.get(rules, None)
    with merge_settings(spark):
        plan = runs.unsettled(spark.range(100).selectExpr("id AS a", "id AS b").groupBy("a", "b").count())
        text = plan._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(rules, None) == before
    assert text.index("SortMergeJoin") < text.index("HashAggregate")  # a hot line is counted before it is dealt
    assert "SortMergeJoin" in text and "LeftAnti" in text and "Broadcast" not in text
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1  # of the batch; none for the run
    settled_side = text[text.index("Scan parquet") - 200 :]
    assert "Exchange" not in settled_side and sorted(r.a for r in plan.collect()) == list(range(50, 100))
    runs.close()


def test_no_python_in_the_plan(spark, docs_of):
    plan = drop_common_lines(docs_of(["a\nb"] * 3))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
