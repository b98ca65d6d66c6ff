import pytest
from llm_data import LONG, PROSE


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows that operators must cope with; their other columns have names that operators use themselves."""
    rows = [
        (1, PROSE, 1, "a"), (2, None, None, None), (3, "", 3, ""), (4, " \t\n ", 4, "x"), (5, LONG, 5, "y"), (6, PROSE, 6, "a"), (6, PROSE, 6, "a"),
        (7, "one", 7, "b"), (None, PROSE, 8, "c"), (8, "日本 語 \u00a0x é\u0301", 9, "d"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words long, shard string").selectExpr("*", "n_words AS key", "shard AS id", "n_words AS code", "shard AS line", "n_words AS row", "shard AS kept", "n_words AS a", "shard AS found", "n_words AS first")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
