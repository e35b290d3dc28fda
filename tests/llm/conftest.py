import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs or rows of (doc_id, text, lang)."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
