from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, _row string, n string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty, blank and very long texts, equal rows, ties, and columns with clashing names."""
    base = " ".join(f"word{i % 97} item{i % 89} thing{i % 83}" for i in range(120))
    near = base.replace("word5 ", "other ", 1)
    rows = [
        (1, base, "en", "a", 1, "x", "y", "z"), (2, near, "en", "a", None, None, None, None), (3, base, None, None, 1, "x", "y", "z"),
        (4, None, "en", "b", 0, "x", "y", "z"), (5, "", "en", "b", 0, "x", "y", "z"), (6, " \t\n ", None, "b", 3, "x", "y", "z"),
        (7, "two words", "en", "b", 9, "x", "y", "z"), (7, "two words", "en", "b", 9, "x", "y", "z"), (8, "TWO  Words", "en", "b", 9, "x", "y", "z"),
        (None, base, "en", "c", 1, "x", "y", "z"), (None, None, None, None, None, None, None, None),
        (9, "long " + " ".join(str(i) for i in range(30000)), "en", "c", 1, "x", "y", "z"), (10, "é" * 60 + " ümlaut 漢字 " + base[:80], "de", "c", 1, "x", "y", "z"),
        *[(11, "the same row over and over again", "en", "hot", 1, "x", "y", "z")] * 40,
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
