import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text), in the usual columns and some with clashing names."""
    def make(rows, extra=False):
        df = spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
        return df.selectExpr("*", "'x' AS start", "'y' AS kind", "1 AS number") if extra else df
    return make


ODD = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (None, "no id at all"),
       (4, "  \n\t "), (5, "word " * 30_000), (6, "x" * 200_000), (7, "ünïcödé 😀 text, with marks.")]


@pytest.fixture
def odd_docs(docs_of):
    return docs_of(ODD, extra=True)
