import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) as a table with all columns of documents and one that clashes with a result."""

    def make(rows):
        full = [(i, t, None, None if i is None or i % 3 == 0 else f"src{i % 3}", len(t or ""), 1) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", size int").repartition(3)

    return make
