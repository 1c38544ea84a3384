import random
from collections import Counter

import numpy as np

from tabml.llm import quality
from tabml.llm.queries import op4_quality_rules

SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words, now = [], ""
    for c in text + " ":
        if c in SPACE:
            words += [now] if now else []
            now = ""
        else:
            now += c
    lines, dup = Counter(), 0
    for s in text.split("\n"):
        if s.strip(SPACE):
            dup += s in lines
            lines[s] += 1
    windows = Counter(zip(words, words[1:], words[2:]))
    held = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(held)


def test_counts_match_brute_force():
    rng = random.Random(6)
    bits = ["a", "b", "Ab", "é", "日本", "#", "|x", " ", "\n", "\n\n", "\t", "\x0b", "\x1c", " ", "!", "1"]
    texts = [None, "", "\n", "a a a a", "a b c a b c", "x " * 50_000] + ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(2000)]
    for t in texts:
        assert quality.count_text(t)[:5] == brute(t), repr(t)


def test_list_recovers_planted_rules_and_prunes_noise():
    rng = np.random.default_rng(1)
    x = rng.random((6000, len(quality.FEATURES)))
    bad = (x[:, 2] > 0.8) | ((x[:, 4] > 0.7) & (x[:, 5] <= 0.3))
    rules = quality.learn_rules(x, bad)
    hit = np.any([quality.covers(r, x) for r in rules], axis=0)
    assert (hit == bad).mean() > 0.98 and len(rules) <= 6
    assert quality.learn_rules(x, rng.random(6000) < 0.1) == []
    assert quality.learn_rules(x[:0], bad[:0]) == [] == quality.learn_rules(x, np.zeros(6000, bool))


def test_equal_gains_take_the_first_feature():
    """Two features that are the same numbers gain alike: the rule names the first."""
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(quality.FEATURES)))
    x[:, 5] = x[:, 2]
    rules = quality.learn_rules(x, x[:, 2] > 0.7)
    assert rules and all(c.feature == quality.FEATURES[2] for rule in rules for c in rule)


def test_held_out_accuracy_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train, test = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    stats = docs.select("doc_id", quality.text_stats(docs.text).alias("stats")).persist()
    judged = quality.judge(stats, quality.fit(stats, train)).join(test, "doc_id").filter("not base_failed").select("quality", "kept").toPandas()
    stats.unpersist()
    assert (judged[judged.quality == 1].kept).mean() > 0.995
    assert (~judged[judged.quality == 0].kept).mean() > 0.9


def test_query_base_columns_match_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in op4_quality_rules(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want, r = brute(d.text), got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_pipeline_form_handles_nulls_extra_columns_and_empty(spark):
    good = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, good, "s"), (1, good, "s"), (None, good, "t"), (2, None, "u"), (3, "", "v"), (4, "short one", "w")], "doc_id bigint, text string, stats string")
    labels = spark.createDataFrame([(1, 1, None), (None, 0, None), (2, None, None)], "doc_id bigint, quality int, toxic int")
    out = quality.keep_good(df, labels)
    assert out.columns == df.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "1", "None"]
    assert quality.keep_good(df.limit(0), labels.limit(0)).count() == 0
