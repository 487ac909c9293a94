from __future__ import annotations

import pytest

from tests.conftest import spark  # noqa: F401

@pytest.fixture(scope="session")
def odd_documents(spark):  # noqa: F811
    """Nulls, empty and very long texts, ties, repeated rows and columns whose names clash with results."""
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "a b c d e f g h i j k l m n o"),
        (6, "a b c d e f g h i j k l m n o"), (6, "a b c d e f g h i j k l m n o"), (None, "no id here at all"),
        (7, "x" * 200_000), (8, "lorem ipsum dolor " * 20_000), (9, "mail joe@mail.example.com +1 (377) 555-0271"),
        (10, "12345.6 \U0001f600 \n\n  two  spaces here "),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr("*", "1 as score", "'x' as kept", "2 as n_words", "array(1) as spans", "'de' as lang")
