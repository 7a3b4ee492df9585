import pytest
from llm_fixtures import DOCS, LONG

from shelfwise.llm.common import importable


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    importable(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows and keys, odd white space."""
    return [
        (7, "the same old words again and again and more of them", "en", "a", 1),
        (7, "the same old words again and again and more of them", "en", "a", 1),
        (7, "another text under a key that is used before", "en", None, 1),
        (None, "no key at all, yet words enough to be a document", "en", "a", None),
        (None, None, None, None, None),
        (3, None, "en", "b", 0),
        (2, "", "en", "b", 0),
        (1, " \n\t  ", None, "b", 4),
        (9, LONG, "en", "a", len(LONG)),
        (10, LONG + " end", "en", "c", len(LONG) + 4),
        (11, "1234 5678 ... !!! 99", "de", "c", 20),
        (12, "der die das und  nicht\n\n ein wort<|endoftext|>", "de", "c", 40),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
