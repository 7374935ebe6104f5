from __future__ import annotations

import pytest

from shelfcast.llm.workers import with_package

SCHEMA = "doc_id bigint, text string, lang string, source string, _row string, _text string, key string, kept string, n_words string"
PROSE = " ".join(f"word{i % 97} of{i % 13} the{i % 7}" for i in range(400))
ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", None), (4, "x" * 300_000, "de", "a"),
    (5, PROSE, "en", "b"), (5, PROSE, "en", "b"), (6, PROSE + " tail", "en", "b"), (6, "other text, same number", "fr", ""),
    (None, PROSE, "en", "b"), (None, None, None, None), (7, "École ÄÖ 日本語 <|endoftext|> <a>  b", "xx", "ü"), (8, PROSE, "en", "a"),
    (9, "word " * 20_000, "en", "c"), (10, "a\n b\n\n a\n  c \n", "", "c"),
]


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    return list(ODD)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like those inside the operators."""
    with_package(spark)
    return spark.createDataFrame([r + ("A", "B", "C", "D", "E") for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    with_package(spark)
    return spark.createDataFrame([], SCHEMA)
