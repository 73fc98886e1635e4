import pytest


@pytest.fixture
def docs(spark):
    """A table of documents from rows of (doc_id, text), with the other columns filled in."""

    def make(rows, more=""):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return df.selectExpr("*", *([more] if more else []))

    return make
