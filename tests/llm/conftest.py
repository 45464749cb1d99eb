import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table."""
    def build(rows):
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS).repartition(3)
    return build
