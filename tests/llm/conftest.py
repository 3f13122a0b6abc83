import pytest

EDGE = [None, "", "  \n\t ", "one", "two words", "the same text here again and again", "the same text here again and again", "x" * 5000, "word " * 3000, "é日本 ñ\u00a0ß\u2028z", "a\x00b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, fp string, shard int, spans string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns named like the operators' own."""
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t or ""), "w", "f", 1, "x") for i, t in enumerate(EDGE)]
    rows += [(3, "one", "en", "s", 3, "w", "f", 1, "x"), (None, "no id", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
