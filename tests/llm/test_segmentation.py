import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabml.llm import segmentation as S
from tabml.llm.queries import PIECES, op6_sentencepiece, tokenizer_path


@pytest.fixture(scope="module")
def pieces():
    return S.load_pieces(tokenizer_path(PIECES))


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))


def every_way(text, pieces):
    """All segmentations of a text with their log-probabilities, by brute force over the vocabulary."""
    ids = {pieces.bytes[k]: k for k in range(len(pieces.bytes)) if pieces.logp[k] > -math.inf}
    whole = " " + text

    def ways(at):
        if at == len(whole):
            return [((), 0.0)]
        out = []
        for end in range(at + 1, len(whole) + 1):
            part = whole[at:end]
            k = ids.get(part.encode())
            inside = part.lstrip(" ")
            if k is not None and " " not in inside:
                out += [((k, *rest), pieces.logp[k] + lp) for rest, lp in ways(end)]
            elif end == at + 1:
                raw = part.encode()
                own = tuple(int(pieces.byte_id[b]) for b in raw)
                out += [((*own, *rest), pieces.byte_logp * len(raw) + lp) for rest, lp in ways(end)]
        return out

    found = ways(0)
    top = max(lp for _, lp in found)
    total = top + math.log(sum(math.exp(lp - top) for _, lp in found))
    return {ids: lp - total for ids, lp in found}


@pytest.mark.parametrize("text", ["Hello", "a  b", "né\nx", "日🙂", " "])
def test_probabilities_match_all_segmentations(pieces, text):
    want = every_way(text, pieces)
    keys = np.arange(300, dtype=np.uint64)
    for t, _, ids, logp, _, inclusion in S.sample_texts([text] * 300, keys, pieces, 3):
        assert math.isclose(logp, want[tuple(ids.tolist())], rel_tol=1e-9, abs_tol=1e-9) and inclusion <= 0


def test_samples_without_replacement_have_the_right_distribution(pieces):
    text, n = "Hello", 20_000
    want = every_way(text, pieces)
    rows = {}
    for t, s, ids, _, score, inclusion in S.sample_texts([text] * n, np.arange(n, dtype=np.uint64), pieces, 2):
        rows.setdefault(t, []).append((tuple(ids.tolist()), score, inclusion))
    assert all(len({i for i, _, _ in r}) == 2 and r[0][1] > r[1][1] for r in rows.values())
    first, second = Counter(r[0][0] for r in rows.values()), Counter((r[0][0], r[1][0]) for r in rows.values())
    likely = sorted(want, key=want.get, reverse=True)[:6]
    for a in likely:
        p = math.exp(want[a])
        assert abs(first[a] / n - p) < 5 * math.sqrt(p / n) + 1e-3
        for b in likely:
            if a != b:
                q = p * math.exp(want[b]) / (1 - p)
                assert abs(second[a, b] / n - q) < 5 * math.sqrt(q / n) + 1e-3
    # inclusion scores weight the sample without bias: sum of p / inclusion has mean one
    total = np.mean([sum(math.exp(want[i] - inc) for i, _, inc in r) for r in rows.values()])
    assert abs(total - 1) < 0.05


def test_all_segmentations_come_out_once_when_asked_for(pieces):
    want = every_way("Hell", pieces)
    got = [tuple(ids.tolist()) for _, _, ids, *_ in S.sample_texts(["Hell"], np.array([7], np.uint64), pieces, 500)]
    assert len(got) == len(set(got)) == len(want) and set(got) == set(want)


def test_round_trip_normalisation_and_own_decoder(pieces, model):
    rng = random.Random(3)
    bits = ["Hello", " ", "  ", "\n", "wörld", "日本語", "🙂", "\t", "x", ".", "́", "     ", "ﬁ"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(200)]
    for t, _, ids, *_ in S.sample_texts(texts, np.arange(200, dtype=np.uint64), pieces, 2):
        assert pieces.decode(ids.tolist()) == texts[t] == model.decode(ids.tolist())
    for t in texts:
        assert pieces.decode(model.encode(t)) == t


def test_rows_depend_on_their_key_alone(spark, pieces, docs_of):
    texts = ["the same text here", "the same text here", None, "", "x" * 60_000, "a\nb"] + [f"text number {i}" for i in range(40)]
    df = docs_of(texts)
    a = {(r.doc_id, r.sample): tuple(r.ids) for r in S.sample_segmentations(df, tokenizer_path(PIECES), k=3).collect()}
    b = {(r.doc_id, r.sample): tuple(r.ids) for r in S.sample_segmentations(df.coalesce(1), tokenizer_path(PIECES), k=3, max_chars=50).collect()}
    assert a == b and a[2, 0] == a[3, 0] == () and (2, 1) not in a and (0, 2) in a
    assert [a[0, s] for s in range(3)] != [a[1, s] for s in range(3)]
    rows = S.decode_ids(S.sample_segmentations(df, tokenizer_path(PIECES), k=1), tokenizer_path(PIECES)).collect()
    assert {r.doc_id: r.text for r in rows} == {i: t or "" for i, t in enumerate(texts)} and all(r.round_trip for r in rows)


def test_round_trip_is_equality_with_the_text(spark, docs_of):
    texts = ["a b", "a\u2581b", "\u2581", "x \u2581 y"]
    rows = S.decode_ids(S.sample_segmentations(docs_of(texts), tokenizer_path(PIECES), k=2), tokenizer_path(PIECES)).collect()
    assert {r.doc_id for r in rows} == {0, 1, 2, 3} and all(r.round_trip == (r.text == texts[r.doc_id]) == (r.doc_id == 0) for r in rows)


def test_null_ids_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(None, "some text"), (None, "some text"), (4, None)], "doc_id bigint, text string").selectExpr("*", "1 as sample", "2 as ids")
    rows = S.sample_segmentations(df, tokenizer_path(PIECES), k=2).collect()
    assert len(rows) == 5 and len({tuple(r.ids) for r in rows if r.doc_id is None}) == 2
    assert S.sample_segmentations(df.limit(0), tokenizer_path(PIECES)).count() == 0


def test_query_covers_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = op6_sentencepiece(spark, sf).collect()
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len({r.doc_id for r in rows}) == n and all(r.round_trip and r.log_inclusion <= 0 for r in rows)


def test_plain_split_equals_the_pattern():
    rng = random.Random(11)
    for _ in range(5000):
        t = "".join(rng.choices(["a", "bc", " ", "é", S.SPACE, "\t"], [5, 5, 4, 1, 0.1, 0.2], k=rng.randint(0, 14)))
        assert S.split_words(t) == (S.WORD.findall(S.SPACE + t.replace(" ", S.SPACE)) if t else []), repr(t)


def test_words_are_coded_in_columns_as_they_are_split():
    rng = random.Random(12)
    bits = ["a", "bc", " ", "  ", "é", "🙂", "\n", "\0", S.SPACE, "\ud800"]
    texts = ["", " ", "a", *["".join(rng.choices(bits, [5, 5, 5, 1, 1, 1, 1, 0.1, 0.2, 0.1], k=rng.randint(0, 14))) for _ in range(2000)], ""]
    for some in (texts, texts[:1], [], ["plain text", "plain text"]):
        words, number, counts = S.coded_words(some)
        split = [S.split_words(t) for t in some]
        flat = [w for found in split for w in found]
        known = [w.decode("utf-8", "surrogatepass") for w in words.to_pylist()]
        assert known == list(dict.fromkeys(flat)) and [known[k] for k in number] == flat and counts.tolist() == [*map(len, split)]


def test_lattice_of_coded_words(pieces):
    """Every piece of the vocabulary is found in the trie; draws never leave a position's edges."""
    normal = [k for k in range(len(pieces.bytes)) if pieces.logp[k] > -math.inf]
    words = [pieces.bytes[k].decode().replace(" ", S.SPACE) for k in normal]
    lat = S.Lattice(pa.array([w.encode() for w in words], pa.large_binary()), pieces)
    assert lat.stop.tolist() == [a + len(w) for a, w in zip(lat.start.tolist(), words)]
    whole = lat.first[lat.start]  # the longest piece comes first
    assert lat.piece[whole].tolist() == normal and (lat.target[whole] == lat.stop).all()
    inside = np.flatnonzero(lat.degree > 0)
    for u in (0.0, 0.5, 1 - 2**-53):
        edge = lat.draw(inside, np.full(len(inside), u))
        assert (lat.source[edge] == inside).all()
    assert np.allclose(np.bincount(lat.source, lat.q)[inside], 1, rtol=1e-12)


def test_equal_scores_take_the_first_found(pieces):
    """Equal keys and texts tie in every score; each text still has its k distinct samples, in falling order."""
    rows = {}
    for t, s, ids, _, score, _ in S.sample_texts(["tied text"] * 4, np.zeros(4, np.uint64), pieces, 3):
        rows.setdefault(t, []).append((s, tuple(ids.tolist()), score))
    assert len(rows) == 4 and all(r == rows[0] for r in rows.values())
    assert len({ids for _, ids, _ in rows[0]}) == 3 and [g for _, _, g in rows[0]] == sorted((g for _, _, g in rows[0]), reverse=True)


def test_query_returns_every_segmentation_and_the_digest_of_its_decoded_text(spark, model):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in op6_sentencepiece(spark, sf).collect():
        assert len(r.ids) == r.n_ids and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert model.decode(list(r.ids)) == texts[r.doc_id]
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_rows_decode_as_one_by_one(pieces, model):
    rng = random.Random(5)
    rows = [None, [], [pieces.byte_id[0xC3]], [int(pieces.byte_id[0x20])] * 2, *[model.encode(t) for t in ("a b", " x", "wörld 🙂", "")]]
    rows += [[rng.randrange(3, len(pieces.size)) for _ in range(rng.randint(0, 9))] for _ in range(300)]
    for some in (rows, rows[:2], [None], [], [model.encode("plain text")] * 3):
        ids = pa.array([r and [int(x) for x in r] if r else r for r in some], pa.list_(pa.int32()))
        assert pieces.decoded_rows(ids).to_pylist() == [None if r is None else pieces.decode(r) for r in some]
        assert pieces.decoded_rows(ids.slice(1)).to_pylist() == [None if r is None else pieces.decode(r) for r in some[1:]]
