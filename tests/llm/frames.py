"""Small inputs shared by the tests of the text operators."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"
ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_words string, rep string"


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like those of the operators."""
    long = "alpha beta gamma delta epsilon " * 6000
    rows = [
        (1, "Hello world, this is a text.", "en", "s", 28, 0.1, "x", "r"),
        (1, "Hello world, this is a text.", "en", "s", 28, 0.1, "x", "r"),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "s", 0, 0.5, "", ""),
        (4, long, "en", "s", len(long), 0.2, "y", "q"),
        (5, "x" * 30000, "en", "s", 30000, 0.2, "y", "q"),
        (6, " \t\n   ", "fr", "s", 5, None, None, "q"),
        (None, "a row without an id", "en", "s", 19, None, None, None),
        (7, "\U0001f600 café über naïve 你好", "fr", "s", 20, 0.0, "z", "q"),
        (8, "!!! ??? ... 123 456", "de", "s", 19, 0.0, "z", "q"),
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def texts(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
