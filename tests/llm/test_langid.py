import random
import zlib

import numpy as np

from tabml.llm import langid
from tabml.llm.queries import op5_language_id


def grams(text, n):
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    low = " " + " ".join(low.split()) + " "
    return {low[i : i + n] for i in range(len(low) - n + 1)}


def test_kernel_matches_brute_force_sets():
    texts = ["The cat's hat.", "über  die Brücke, 12", "a", "Ñandú\nñandú"]
    marks = langid.Landmarks.of(texts)
    values, known = langid.project(texts + ["", None, "123 !"], marks.slots, marks.scaled)
    assert known.tolist() == [True] * 4 + [False] * 3
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            want = np.mean([len(grams(a, n) & grams(b, n)) / np.sqrt(len(grams(a, n)) * len(grams(b, n))) for n in langid.ORDERS])
            assert abs(values[i, j] - want) < 1e-3


def test_held_out_accuracy_and_range(spark):
    sf = "/root/testdata/sf0.01"
    rows = op5_language_id(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.97


def test_only_the_text_of_a_row_decides(spark):
    rng = random.Random(4)
    words = {"x1": ["alpha", "beta"], "x2": ["zouk", "quiz"]}
    rows = [(i, " ".join(rng.choices(words[k], k=8)), k, "s") for i in range(60) for k in ("x1", "x2")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, place string").repartition(3)
    model = langid.fit(df, max_rows=40, n_landmarks=10)
    odd = spark.createDataFrame([(1, "Alpha BETA", "x2"), (1, "Alpha BETA", None), (None, "quiz!", "x1"), (3, None, "x1"), (4, "12 34", "x1"), (5, "", "x1"), (6, "zouk " * 50_000, None)], "doc_id bigint, text string, lang string")
    got = sorted((str(r.doc_id), r.lang_pred) for r in langid.predict(odd, model).collect())
    assert got == [("1", "x1"), ("1", "x1"), ("3", "und"), ("4", "und"), ("5", "und"), ("6", "x2"), ("None", "x2")]
    assert langid.predict(odd.limit(0), model).count() == 0


def test_every_language_is_learned(spark):
    n = 230
    words = [[f"{chr(0x4E00 + 9 * k + j)}{chr(0x6E00 + 9 * k + j)}" for j in range(8)] for k in range(n)]
    rows = [(20 * k + i, " ".join(words[k][j % 8] for j in range(i, i + 6)), f"l{k:03d}") for k in range(n) for i in range(2 if k == 229 else 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(df)
    assert model.classes == [f"l{k:03d}" for k in range(n)]
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_no_labels_gives_und(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en"), (3, "77", "en")], "doc_id bigint, text string, lang string")
    for part in (df, df.limit(0), df.filter("doc_id = 1")):
        assert all(r.lang_pred == "und" and r.score == 0 for r in langid.predict(df, langid.fit(part)).collect())


def test_spectra_from_tasks_are_those_of_the_texts():
    for text in ("The cat's hat.", "a", "über  die Brücke, 12" * 500, "Ñandú\nñandú"):
        want = langid.spectrum(text)
        got = langid._from_bits(langid._to_bits(want))
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(got, want, strict=True))


def test_equal_scores_take_the_first_language_by_name(spark):
    """The same texts under both names: every score ties."""
    rows = [(i, f"same words here {i % 7}", lang) for i in range(14) for lang in ("zz", "aa")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(df, max_rows=200, n_landmarks=20)
    model.matrices = [np.repeat(m.mean(axis=1, keepdims=True), 2, axis=1) for m in model.matrices]  # rounding of the fit aside
    got = langid.predict(df, model).collect()
    assert model.classes == ["aa", "zz"] and {r.lang_pred for r in got} == {"aa"} and all(abs(r.score - 0.5) < 1e-6 for r in got)


def test_very_long_landmark_texts(spark):
    """Landmarks much longer than other texts: the fit gathers their slots, not their characters."""
    rows = [(i, "alpha beta gamma " * (40_000 if i == 0 else 3), "x1") for i in range(20)] + [(100 + i, "zouk quiz xylo " * 3, "x2") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(df, max_rows=40, n_landmarks=40)
    assert {(r.doc_id >= 100, r.lang_pred) for r in langid.predict(df, model).collect()} == {(False, "x1"), (True, "x2")}
