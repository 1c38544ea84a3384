import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import maxent
from tabml.llm.maxent import UNKNOWN, WIDTH, Counts, Weights, score_texts

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def learned(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 != 1


def brute(rows):
    count = Counter(t for i, text in rows if learned(i) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    out = []
    for i, text in rows:
        base = sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(text))
        out.append((i, learned(i), len(tokens(text)), sum(count[t] > 0 for t in tokens(text)), n, base))
    return sorted(out, key=repr)


def scored(spark, rows, df=None, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3) if df is None else df
    return score_texts(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, **options).collect()


def check(got, rows):
    want = brute(rows)
    got = sorted(((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


def corpus(n, seed=0):
    """Two languages of their own words; the next word follows the last one."""
    rng = random.Random(seed)
    words = {lang: [f"{lang}{i}" for i in range(40)] for lang in "xy"}
    rows = []
    for i in range(n):
        lang, at, text = rng.choice("xy"), rng.randrange(40), []
        for _ in range(rng.randint(1, 80)):
            text.append(words[lang][at].upper() if rng.random() < 0.1 else words[lang][at])
            at = (at * 3 + rng.randint(0, 2)) % 40
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("block_bytes", [1, 1 << 23])
def test_counts_and_base_match_brute_force(spark, block_bytes):
    rows = corpus(300)
    got = scored(spark, rows, block_bytes=block_bytes)
    check(got, rows)
    held = [r for r in got if not r.train]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)  # the context tells much here


def test_edge_texts(spark):
    rows = [(i, t) for i, t in enumerate([None, "", " \t\n\x0b\x0c\r ", "É é", "A a\x1cb c", "x" * 100_000, "w " * 100_000, "same", "same", "same"])]
    rows += [(None, "null id"), (None, None), (3, "É é"), (3, "É é")]
    got = scored(spark, rows)
    check(got, rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_empty_table_no_training_rows_and_extra_columns(spark):
    rows = corpus(20)
    df = spark.createDataFrame([(*r, 1, "b", "w") for r in rows], "doc_id bigint, text string, block int, word string, tokens string")
    check(scored(spark, rows, df), rows)
    assert scored(spark, rows, df.limit(0)) == []
    none = score_texts(df, F.lit(False)).collect()
    assert len(none) == 20 and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)


def test_probabilities_sum_to_one():
    """Over all words and the unknown one, in any context: leaves sum to one, and words to one in their leaf."""
    rng = np.random.default_rng(0)
    model = Counts(1000, 100, rng.random(WIDTH * WIDTH) * 50 + 0.5, np.zeros(WIDTH * WIDTH))
    weights = Weights(model)
    leaves = np.arange(WIDTH * WIDTH, dtype=np.uint32)
    context = [np.full(len(leaves), x, np.uint32) for x in (5, 77, 12345)]
    for _ in range(5):
        weights.batch([rng.integers(0, 9, 500).astype(np.uint32) for _ in range(3)], rng.integers(0, UNKNOWN, 500).astype(np.uint32), 0.5)
        weights.batch([c[:100] for c in context], leaves[:100], 0.5)
    assert np.exp(weights.batch(context, leaves)).sum() == pytest.approx(1, abs=1e-4)


def test_training_in_rounds_improves_on_the_counts(spark):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    encoded = maxent.written(maxent.encode(df, "doc_id", "text", F.lit(True), 4_000), "t")
    placed, model = maxent.count_words(encoded)
    blocks = maxent.written(maxent.join_counts(encoded, placed), "t")
    assert blocks.count() > 2 and model.tokens == sum(len(tokens(t)) for _, t in rows)
    one = maxent.train(blocks, model, 1, 0.5, 64, 1 << 20)
    three = maxent.train(blocks, model, 3, 0.5, 64, 1 << 20)
    total = lambda w: maxent.score(blocks, model, w, 64).agg(F.sum("score")).first()[0]
    base = maxent.score(blocks, model, Weights(model), 64).agg(F.sum("score")).first()[0]
    assert total(one) > base and total(three) > base
