import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tabml.llm import quality, secrets
from tabml.llm.queries import tokenizer_path
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_quality import brute as brute_stats
from tests.llm.test_simhash import brute as brute_near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.toPandas()]
    for _, stage in pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema) if stage is not pipeline.packing else stage(spark, docs, SF)
        out.append(docs.toPandas())
    return [p.set_index("doc_id", drop=False).sort_index() for p in out]


def test_order_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "secret_scan", "packing"]
    assert all(list(p.columns) == list(stages[0].columns) for p in stages[:-1])
    assert all((p.text.str.len() == p.n_chars).all() for p in stages[:-1])


def test_quality_keeps_what_passes(spark, stages):
    before, after = stages[0], stages[1]
    stats = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", quality.text_stats(F.col("text")).alias("stats"))
    rules = quality.fit(stats, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = {r.doc_id for r in quality.judge(stats, rules).filter("rule IS NOT NULL").collect()}
    want = [i for i, t in before.text.items() if not ((c := brute_stats(t))[0] < 50 or 100 * c[4] > 50 * c[0]) and i not in rejected]
    assert after.index.tolist() == want and (after.text == before.text[want]).all()


def test_lines_near_duplicates_and_secrets_match_brute_force(stages):
    _, good, lines, near, masked, _ = stages
    assert lines.text.tolist() == [t for t, _, _ in brute_lines(good.text.tolist())]
    components = brute_near(list(lines.text.items()))
    assert near.index.tolist() == sorted({c for _, c in components.values()})
    assert (near.text == lines.text[near.index]).all()
    for i, t in near.text.items():
        base = [(s, e) for k, s, e, _ in secrets.candidates(t) if k < 3]
        assert masked.text[i] == secrets.mask_spans(t, base, "[SECRET]")


def test_packed_ids_are_the_texts(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    packed, docs = stages[-1], stages[-2]
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in docs.text.items()}
    assert packed.groupby(level=0).length.sum().to_dict() == lengths
    for _, g in packed.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.concatenate(([0], g.length.cumsum()[:-1]))).all() and g.length.sum() <= 4096


def test_run_and_odd_rows(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(1, long, None, "s", 5), (1, long, None, "s", 5), (2, None, "en", None, None), (None, long + " token=0123456789abcdef0123456789", "en", "s", 1), (3, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) >= 1 and len({r.sequence_id for r in out}) == 1
    spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_labels_decide_what_the_secret_stage_masks(spark):
    """A key copied over sources stays, one owner's key goes wherever it stands, so does one of a single document."""
    prose = " ".join(f"word{i}" for i in range(60))
    spread, owned, single = "api_key = Qx71bV93KtZ5mm2Rw8Lc", "api_key = Zk39fQ81LmX0aa7Tq2Pw", "token: Hd82nS64PyW1cc9Ve3Gb"
    rows = [(i, f"{prose} {spread} {i}", "en", f"s{i % 6}", 0) for i in range(12)]
    rows += [(100 + i, f"{prose} {owned} {i}", "en", "mine", 0) for i in range(12)]
    rows += [(200, f"{prose} {single} and {spread}", "en", "s9", 0), (201, None, None, None, None), (202, prose, "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in pipeline.secret_scan(spark, docs, SF).collect()}
    assert len(got) == len(rows) and got[201].text is None and got[202].text == prose
    assert all(got[i].text == f"{prose} {spread} {i}" for i in range(12))
    assert all(got[100 + i].text == f"{prose} [SECRET] {i}" for i in range(12))
    assert got[200].text == f"{prose} [SECRET] and {spread}" and got[200].n_chars == len(got[200].text)
