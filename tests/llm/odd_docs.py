"""Documents that operators must handle, and a fixture that makes tables of documents."""

import pytest

#: Null, empty, white space, ties, repeated rows, null ids and a long text.
ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "one two three four five six"), (5, "one  two three four five six"), (5, "one  two three four five six"),
    (None, "one two three four five six"), (None, None), (6, "word " * 50_000), (7, "Ärger über ß " * 20),
]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or (doc_id, text) pairs, with extra columns whose names operators use inside."""
    schema = "doc_id long, text string, row long, block string, component string, size int, lang string"

    def make(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, 7, "b", None, None, "en") for i, t in pairs], schema).repartition(3)

    return make


@pytest.fixture()
def odd():
    return list(ODD)
