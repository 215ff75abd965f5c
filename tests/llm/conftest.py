import pytest


@pytest.fixture
def frame(spark):
    """A DataFrame of documents from (doc_id, text) pairs and any extra columns."""

    def make(rows, extra="", schema=None):
        return spark.createDataFrame(rows, schema or f"doc_id long, text string{extra}")

    return make
