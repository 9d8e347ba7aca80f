import pytest

from lossmill.llm.shipping import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def table(spark):
    """A document table from (id, text) pairs, with columns whose names the operators use themselves."""

    def made(rows, parts=3):
        schema = "doc_id long, text string, lang string, `key` string, kept int, marks array<int>, score string"
        return spark.createDataFrame([(a, b, "en", "k", 1, [1], None) for a, b in rows], schema).repartition(parts)

    return made


@pytest.fixture
def odd(table):
    """NULL ids and texts, empty texts, repeated rows, one id with two texts, a long word."""
    rows = [(1, "a b c"), (1, "a b c"), (1, "other text here"), (None, "a b c"), (None, None), (2, None), (3, ""), (4, " \n\t"), (5, "x" * 70_000)]
    return table(rows)
