import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_helpers import DOCS, table, words  # noqa: E402


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, odd characters."""
    long = words(1, 30_000, 5000)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, long, "en", "a"), (5, long + " end", None, "b"),
        (6, "the same of it", "en", "b"), (6, "the same of it", "en", "b"), (6, "another text of the same id", "de", None),
        (None, "no id at all here", "fr", "b"), (None, None, None, None), (7, "the same of it", "en", "c"), (8, "x" * 50_000, "en", "c"),
        (9, "\x01\x02 \U0001F600 Ünïcödé ß é <|endoftext|>", "de", "c"), (10, "A a A a", "en", "a"), (-3, "negative id of the row", "en", "a"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return table(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
