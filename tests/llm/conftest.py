import pytest

LONG = " ".join(f"word{i % 97} of line{i % 13}\n" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, host string, row_key long, n long, kept boolean, spans string, kept_id long, shard string, component_id long"


def _row(doc_id, text, source="s1"):
    return (doc_id, text, "en", source, None if text is None else len(text), 1, "x", 2, 3, False, "y", 4, "z", 5)


ROWS = [
    _row(1, None),
    _row(2, ""),
    _row(3, "one two three four five six " * 20),
    _row(3, "one two three four five six " * 20),
    _row(None, "a text without id, call +1 (212) 555-0153 or a.b@c.example"),
    _row(4, " \t\n "),
    _row(5, LONG, None),
    _row(6, "Être où ça – naïve 日本語 𝔘nicode <|endoftext|> x@y.org 10.0.0.1 password = hunter22 " * 3, "s2"),
    _row(7, "x" * 50_000, "s2"),
    _row(8, "1" * 5_000 + " x 4111 1111 1111 1111", "s2"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every kind of column, empty, blank and very long texts, repeated rows, a null id, clashing column names."""
    from tripmart.llm.common import importable

    importable(spark)
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
