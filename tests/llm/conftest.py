import pytest

# rows that every operator must take: NULLs, empty and long texts, ties, repeated rows, clashing names of other columns
EDGE = "doc_id bigint, text string, lang string, source string, kept string, key string, tag string, spans string, n bigint, body string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with other columns whose names the operators use inside."""
    def make(rows, langs=None):
        return spark.createDataFrame([(i, t, langs[k] if langs else None, "src0", "x", "y", "z", "s", 1, "b") for k, (i, t) in enumerate(rows)], EDGE)
    return make
