import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tabml.llm import packing
from tabml.llm.queries import tokenizer_path


def check_places(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pieces_match_the_tokenizer_and_places_are_gapless(spark, docs_of, tokenizer):
    rng = random.Random(3)
    words = ["The", "of", "naïve", "İstanbul", "ΣΑΣ", "don't", "it's.", "x'", "'s", "a1b2", "...", "%%%", "é", "é", "日本語", "…", " ", "\t", "AB,", "(x)", "̸=", "1,000.50", "<|endoftext|>", " "]
    texts = [None, "", " ", "\n", "word " * 9000] + [rng.choice(["", " ", "\n"]).join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(150)]
    texts += [" ".join(rng.choices(words, k=60)) for _ in range(60)] + ["same text"] * 30
    rows = packing.pack_documents(docs_of(texts), tokenizer_path(), capacity=512, with_ids=True).collect()
    want = {}
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 512):
            want[i, k // 512] = ids[k : k + 512]
    assert {(r.doc_id, r.piece): np.frombuffer(r.ids, "<u4").tolist() for r in rows} == want and len(rows) == len(want)
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.start == 512 * r.piece and r.length == len(r.ids) // 4 for r in rows)
    total = sum(map(len, want.values()))
    assert check_places(rows, 512) <= -(-total // 512) + 1
    df = spark.createDataFrame(rows)
    seqs = packing.sequences(df).collect()
    assert sum(len(r.ids) for r in seqs) == 4 * total and all(len(r.ids) == 4 * r.length for r in seqs)


def test_plans_place_every_count_and_come_near_the_bound():
    rng = random.Random(1)
    for hist in ({7: 1000}, {60: 5, 50: 5, 40: 5}, {51: 3, 50: 4, 100: 2, 1: 9}, dict(Counter(min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(5000)))):
        plan = packing.solve(hist, 100)
        used = Counter()
        for chosen, times in plan:
            assert sum(n * k for n, k in chosen.items()) <= 100 and times > 0
            for n, k in chosen.items():
                used[n] += k * times
        assert used == hist
    bound = -(-sum(n * k for n, k in hist.items()) // 100)
    assert sum(t for _, t in plan) <= 1.01 * bound + 1


def test_knapsack_is_exact():
    rng = random.Random(2)
    for _ in range(20):
        items = [(rng.randint(1, 12), rng.randint(1, 3), rng.random()) for _ in range(4)]
        items = list({n: (n, k, v) for n, k, v in items}.values())
        got = packing.knapsack(items, 20)
        best = 0.0

        def walk(i, room, value):
            nonlocal best
            best = max(best, value)
            if i < len(items):
                n, k, v = items[i]
                for c in range(min(k, room // n) + 1):
                    walk(i + 1, room - c * n, value + c * v)

        walk(0, 20, 0.0)
        worth = {n: v for n, _, v in items}
        assert abs(sum(worth[n] * c for n, c in got.items()) - best) < 1e-9


def test_the_fractional_solution_covers_no_more_than_there_is_and_its_bound_holds():
    rng = random.Random(5)
    for hist in (dict(Counter(rng.randint(5, 60) for _ in range(20_000))), {7: 1000}, {60: 500, 41: 300, 39: 10}, dict(Counter(rng.randint(1, 100) for _ in range(5000)))):
        found = packing.fractional(hist, 100)
        used = Counter()
        for column, weight in found.weights.items():
            assert weight > 0 and sum(n * c for n, c in column) <= 100
            for n, c in column:
                used[n] += c * weight
        assert found.weights and all(used[n] <= k * (1 + 1e-9) for n, k in hist.items())
        plain = sum(t for _, t in packing.best_fit(hist, 100))
        best = sum(t for _, t in packing.solve(hist, 100))
        assert found.bound <= best + 1e-6 and found.bound <= plain + 1e-6 and best <= 1.001 * plain + 1
        assert found.bound >= sum(n * k for n, k in hist.items()) / 100 - 1e-6 or len(hist) < 4


def test_the_bound_sees_more_than_the_volume():
    assert packing.fractional({60: 500}, 100).bound > 499  # no two fit: 300 by volume
    assert sum(t for _, t in packing.solve({60: 500}, 100)) == 500


def test_empty_table_null_ids_and_small_cache(spark, docs_of):
    df = docs_of(["a b", None]).selectExpr("cast(null as bigint) as doc_id", "text", "1 as length", "2 as _salt")
    rows = packing.pack_documents(df, tokenizer_path()).collect()
    assert len(rows) == 2 and check_places(rows, 4096) == 1
    assert packing.pack_documents(df.limit(0), tokenizer_path()).count() == 0
    small, large = (packing.WordIds(packing.word_ids(tokenizer_path(), limit).tokenizer, limit) for limit in (5, 10**6))
    texts = [f"w{i % 7} the x{i}." for i in range(300)]
    for at in range(0, 300, 10):
        ids, places = small.encode(pa.array(texts[at : at + 10]))
        want, same = large.encode(pa.array(texts[at : at + 10]))
        assert ids.tolist() == want.tolist() and places.tolist() == same.tolist()
    assert len(small.old) < 60 < len(large.young)
