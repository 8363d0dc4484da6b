"""Fixtures of the operator tests; a test module imports them by name."""

import pytest

SF0001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: nulls, empty, whitespace, repeats, ties, long and odd texts; extra columns whose names clash with the operators' own
ODD_TEXTS = [
    None, "", " ", "a", "a", "a b  c", "\t\n x \x1c y", "it's <|endoftext|> 'll", "日本語 text", "é" * 300,
    "same words here " * 40, "same words here " * 40, "w" * 5000, " ".join(f"t{i}" for i in range(9000)),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD_TEXTS)] + [(3, "a", "en", "s", 0), (None, "a", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "1 AS sha", "'x' AS part", "2 AS keep", "3 AS row", "4 AS salt", "5 AS copies", "6 AS start")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
