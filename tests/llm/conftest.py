import pytest

DOCS = "doc_id long, text string, n_tokens string, length string, label int, bucket int"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as documents with columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", "y", 7, 7) for i, t in rows], DOCS)

    return make
