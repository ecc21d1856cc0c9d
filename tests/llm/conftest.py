import pytest


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""
    def build(rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, simhash string, word binary, n int"
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), "x", b"w", 7) for r in rows]
        return spark.createDataFrame(full, schema)
    return build
