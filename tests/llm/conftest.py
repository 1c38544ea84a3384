import pytest


@pytest.fixture
def docs_of(spark):
    """A small ``documents`` table from texts or (text, lang, source) rows; ids from 0."""

    def make(rows):
        full = [(r, "en", "src0") if r is None or isinstance(r, str) else r for r in rows]
        data = [(i, t, lang, source, None if t is None else len(t)) for i, (t, lang, source) in enumerate(full)]
        return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)

    return make
