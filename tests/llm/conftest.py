from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, _row int, fingerprint string, score int, `a.b` int"
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "s1", 5, "x", 1, "f", 1, 1),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "s1", 5, "x", 1, "f", 1, 1),
    (2, "the quick brown fox jumps over the lazy dog again and again", "en", None, None, None, None, None, None, None),
    (3, None, None, "s2", None, None, 3, None, 2, 2),
    (4, "", "de", "s2", 0, "y", 4, "g", 3, 3),
    (None, "All rights reserved. Grüße an alle", "de", "s1", 1, None, 5, None, None, 4),
    (None, None, None, None, None, None, None, None, None, None),
    (7, "wort " * 30_000 + "\n" + "ß" * 5000, "de", "s3", 1, "z", 6, "h", 4, 5),
    (8, " \t\n ", "fr", "s3", 4, "z", 7, "h", 5, 6),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra columns whose names could clash."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def read(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
