"""The registered ``opN_*`` queries: each applies its operator to the whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm._common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


#: Fixed values of the contract: rules as (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op1_url_filters",
    r"""
    WITH rules(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
        ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    parts AS (SELECT row_number() OVER () AS n, page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
    best AS (SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(v, length(rhost || rpath)) AS v
        FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n)
    SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
    """,
)
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.url_filter import filter_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op10_exact_dedup",
    r"""
    WITH norm AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
    best AS (SELECT t, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM norm JOIN best USING (t)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle_words=4, max_bits=4)


@query(
    "op8_line_dedup",
    r"""
    WITH docs AS (SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    lines AS (SELECT n, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
    keyed AS (SELECT n, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
    common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT n) >= 10),
    marked AS (SELECT keyed.*, common.k IS NOT NULL AS gone FROM keyed LEFT JOIN common USING (k)),
    cut AS (SELECT n, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM marked GROUP BY n)
    SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN cut USING (n)
    """,
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.line_dedup import drop_common_lines

    cut = drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: Fixed values of the contract.
SEQUENCE_TOKENS, END_ID, TOKENIZER = 4096, 1, "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.packing import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), end_id=END_ID, capacity=SEQUENCE_TOKENS)
    return packed.drop("ids")


@query("op7_html_extract")
def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.html_extract import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.secrets import KINDS, scan_secrets

    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.stop)), ",")
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("bigint")
    base = F.filter("spans", lambda s: s.kind < 3)
    label = lambda name: F.size(F.filter("spans", lambda s: s.label == name)).cast("bigint")
    return found.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), label("live").alias("n_live"), label("example").alias("n_example"),
    )


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm._common import written
    from tabml.llm.quality import fit, judge, text_stats

    docs = table(spark, sf_dir, "documents")
    stats = written(docs.select("doc_id", text_stats(F.col("text")).alias("stats")), "stats")
    rules = fit(stats, table(spark, sf_dir, "labels"))
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(stats, rules).select("doc_id", *[f"stats.{c}" for c in shown], "base_failed", "kept", "rule")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.langid import fit, held_out, predict

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Production parameters of the sampler: samples for each text, seed of the row keys.
SEGMENTATIONS, SEED, PIECES = 2, 0, "piece_bpe_32k.model"


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.segmentation import decode_ids, sample_segmentations

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_path(PIECES)
    rows = decode_ids(sample_segmentations(docs, model, k=SEGMENTATIONS, seed=SEED), model)
    return rows.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


@query(
    "op13_merkle",
    r"""
    WITH RECURSIVE docs AS (SELECT doc_id, source, lang, n_chars, text,
        list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
            lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]),
                lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc FROM documents),
    fields AS (SELECT doc_id, lang, crc, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
        || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
        || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head, text,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text FROM docs),
    hashed AS (SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(octet_length(encode(lower_text)) || ':' || lower_text, '-')) AS other, xor(crc, 4294967295) % 3 = 0 AS hit FROM fields),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS size FROM hashed),
    nodes AS (SELECT 0 AS level, lang, i, size, leaf AS h FROM leaves
        UNION ALL SELECT level + 1, lang, i // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE size > 1 GROUP BY ALL),
    tops AS (SELECT lang, level, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS size FROM nodes WHERE size = 1),
    crown AS (SELECT 0 AS level, i, size, h FROM tops
        UNION ALL SELECT level + 1, i // 8, (size + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE size > 1 GROUP BY ALL),
    runs AS (SELECT false AS above, lang, level, i // 8 AS up, (any_value(size) + 7) // 8 AS size, list(h ORDER BY i) AS hs FROM nodes WHERE size > 1 GROUP BY ALL
        UNION ALL SELECT true, NULL, level, i // 8, (any_value(size) + 7) // 8, list(h ORDER BY i) FROM crown WHERE size > 1 GROUP BY ALL),
    climb AS (SELECT row_number() OVER () AS n, doc_id, leaf, lang, false AS above, 0 AS level, i, size, CASE WHEN hit THEN other ELSE leaf END AS folded, '' AS proof FROM leaves
        UNION ALL (
            WITH here AS (SELECT c.n, c.doc_id, c.leaf, c.lang, c.above OR c.size = 1 AS above, CASE WHEN c.size = 1 AND NOT c.above THEN 0 ELSE c.level END AS level,
                CASE WHEN c.size = 1 AND NOT c.above THEN t.i ELSE c.i END AS i, CASE WHEN c.size = 1 AND NOT c.above THEN t.size ELSE c.size END AS size, c.folded, c.proof
                FROM climb c JOIN tops t ON c.lang IS NOT DISTINCT FROM t.lang WHERE c.size > 1 OR NOT c.above)
            SELECT n, doc_id, leaf, here.lang, here.above, here.level + 1, i // 8, coalesce(r.size, 1),
                CASE WHEN r.hs IS NULL THEN folded ELSE sha256(array_to_string(r.hs[:i % 8] || [folded] || r.hs[i % 8 + 2:], '')) END,
                CASE WHEN r.hs IS NULL THEN proof ELSE proof || array_to_string(r.hs[:i % 8] || r.hs[i % 8 + 2:], '') END
            FROM here LEFT JOIN runs r ON r.above = here.above AND (here.above OR r.lang IS NOT DISTINCT FROM here.lang) AND r.level = here.level AND r.up = here.i // 8)),
    done AS (SELECT *, (SELECT h FROM crown WHERE size = 1) AS root FROM climb WHERE above AND size = 1)
    SELECT doc_id, leaf, h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM done JOIN tops ON done.lang IS NOT DISTINCT FROM tops.lang
    """,
)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.merkle import merkle_manifest

    docs = table(spark, sf_dir, "documents")
    return merkle_manifest(docs, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)


@query(
    "op12_lexical",
    r"""
    WITH words AS (SELECT row_number() OVER () AS n, doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    size AS (SELECT count(DISTINCT n) AS n_docs, count(*) AS n_terms FROM words),
    doc AS (SELECT n, any_value(doc_id) AS doc_id, 75 + (25 * count(*) * (SELECT n_docs FROM size)) // (SELECT n_terms FROM size) AS m FROM words GROUP BY n),
    tf AS (SELECT n, term, count(*) AS tf FROM words GROUP BY n, term),
    weight AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT n_docs FROM size) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
    asked AS (SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    scored AS (SELECT q, any_value(item_id) AS item_id, n, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
        FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN doc USING (n) GROUP BY q, n),
    placed AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
    """,
)
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.lexical import ranked_search

    return ranked_search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op11_language_model")
def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabml.llm.maxent import score_texts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    scored = score_texts(docs, learned)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
