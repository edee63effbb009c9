import pytest

from segmint.llm.common import ship

DOCS = "doc_id long, text string, lang string, _hot string, name string, k string"
LONG = " ".join(f"w{i} x{i % 7}" for i in range(3000))


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def edge(llm):
    """Nulls, empty, blank and long texts, ties, repeated rows, columns whose names an operator uses itself."""
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four"), (6, LONG), (7, LONG),
             (7, LONG), (None, LONG), (None, None), (8, "x" * 50_000), (9, "é ñ  漢字 😀 \u00a0 end"), (4, "other words here")]
    return llm.createDataFrame([(i, t, "en", "a", None, "b") for i, t in texts], DOCS)


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], DOCS)
