import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabml.llm._common import written
from tabml.llm.lexical import Ranking, Treap, build_index, build_treap, count_terms, ranked_search, search, search_block, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "ñandú", "語"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [1, 3_000, 1 << 24])
def test_matches_brute_force_over_blocks(spark, block_bytes):
    docs, items = corpus(1, 400), corpus(2, 12) + [(50, "w0 w0 w0 unknown"), (51, None), (52, ""), (53, "... !")]
    d, q = frames(spark, docs, items)
    index, n_docs = build_index(d, block_bytes=block_bytes)
    got = result(search(written(index, "index"), n_docs, q, max_items=5))
    assert got == brute(docs, items)


def test_edge_rows_ties_and_repeats(spark):
    docs = [(i, "same words here") for i in range(90, 0, -1)] + [(7, "same words here"), (None, "same words here"), (None, None), (200, ""), (201, "\x00!?")]
    docs += [(300, "long Same " * 200_000), (301, "a b ÉÀ éà x1y2 __init__ A-Z"), (302, "only")]
    items = [(1, "SAME words"), (1, "SAME words"), (None, "é ÉÀ"), (2, "init a b only only"), (3, "a b")]
    d, q = frames(spark, docs, items)
    assert result(ranked_search(d, q)) == brute(docs, items)
    assert result(ranked_search(d, q, k=200)) == brute(docs, items, 200)


def test_empty_tables_and_extra_columns(spark):
    docs, items = corpus(3, 30), corpus(4, 3)
    d, q = frames(spark, docs, items)
    more = d.selectExpr("*", "1 AS score", "'x' AS terms", "2 AS item"), q.selectExpr("*", "3 AS rank", "'y' AS doc_id")
    assert result(ranked_search(*more)) == brute(docs, items)
    assert ranked_search(d.limit(0), q).count() == 0 and ranked_search(d, q.limit(0)).count() == 0
    one = d.limit(1).selectExpr("doc_id", "'solo' AS text"), q.selectExpr("item_id", "'Solo' AS text").limit(1)
    assert [(r["rank"], r.score > 0) for r in ranked_search(*one).collect()] in ([(1, True)], [])


def test_terms_follow_the_pattern():
    texts = ["A b_c", None, "", "été-ÉTÉ 12ab\tZ q\x7fr", "0123", "x"]
    names, term, owner = terms_of(pa.array(texts))
    got = [[names[int(t)].as_py() for t, o in zip(term, owner) if o == i] for i in range(len(texts))]
    assert got == [terms(t) for t in texts] and count_terms(pa.array(texts)).tolist() == [len(g) for g in got]
    assert count_terms(pa.array(texts)[1:4]).tolist() == [len(g) for g in got[1:4]]


def test_treap_is_compressed_and_bounds_hold():
    rng = np.random.default_rng(0)
    cells = np.unique(rng.integers(0, 300 * 37, 900))
    rows, cols, impact = cells // 37, cells % 37, rng.integers(1, 1000, len(cells))
    t = build_treap(rows, cols, impact, 300, 37)
    assert len(t["depth"]) < len(cells) and ((t["child"] >= 0).sum(1) >= 2).all()  # no unary node
    for node, kids in enumerate(t["child"]):
        below = [t["leaf_best"][c] if c < len(cells) else t["best"][c - len(cells)] for c in kids if c >= 0]
        assert t["best"][node] == max(below)
    treap = Treap(t["leaf_code"], t["leaf_best"], t["depth"], t["first"], t["best"], t["child"], t["levels"], 37)
    asked, weights = np.array([3, 17, 255, 299]), np.array([5, 1, 7, 2])
    total = np.zeros(37, np.int64)
    for r, c, x in zip(rows, cols, impact):
        total[c] += x * weights[asked == r].sum()
    ranking = Ranking(5)
    search_block(treap, np.arange(37), np.zeros(37, bool), asked, weights, ranking, at_once=2)
    best = [c for c in np.lexsort((np.arange(37), -total)) if total[c] > 0][:5]
    assert ranking.id.tolist() == best and ranking.score.tolist() == total[best].tolist()
