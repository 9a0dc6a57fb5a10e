from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor sit amet " * 3000
# Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns.
ROWS = [
    (1, "One plain line of text that is quite long\nsecond line of the very same text", "en", "a", 1),
    (1, "One plain line of text that is quite long\nsecond line of the very same text", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "de", "a", 2),
    (4, LONG, "en", "b", 3),
    (5, LONG, "en", "b", 3),
    (None, "a text without an id of its own", "fr", None, None),
    (None, None, None, None, None),
    (6, "  \t\n \r\n  ", "fr", "c", 0),
    (7, "Ünïcode wörds 漢字 かな 😀 <|endoftext|> and  two   spaces", "de", "c", 9),
    (-8, "12 34 &&& *** !!!", None, "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, size int"
CLASHING = ("contamination", "toxicity", "language", "mix_plan", "mix_copy", "key", "kept", "doc", "fp", "root", "gains", "h", "host")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents of the awkward kinds, with extra columns named like those the operators make."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.select("*", *[F.lit(n).alias(c) for n, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def none(spark, odd):
    return odd.where("doc_id = 123456789")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
