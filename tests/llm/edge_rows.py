import pytest

EDGE = [
    (1, "", "a"),
    (2, None, "a"),
    (None, "A text without an id, which is long enough to be a paragraph of its own, I think.", None),
    (3, "one", "b"),
    (3, "one", "b"),
    (4, " \t\n ", "b"),
    (5, "words and more words " * 20_000, "b"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, repeated rows and columns whose names clash with the operators' own."""
    rows = [(*r, 0.5, "x", 7) for r in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double, label string, size int")


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.filter("doc_id = -1")
