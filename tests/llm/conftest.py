import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from (doc_id, text) with extra columns whose names operators also use."""

    def build(rows):
        return spark.createDataFrame([(i, t, "en", "src0", 1, "x", "y", 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, fp string, th long")

    return build
