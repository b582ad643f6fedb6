"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, component_id string, row_key string, judged string"


def words(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 997}" for i in range(n))


def rows():
    texts = [None, "", " \t\n", "one", "One", words(1, 60), words(1, 60), words(1, 60) + " end", words(2, 5000), words(3, 200)]
    texts += ["the same line\n" * 40, words(4, 80).upper(), words(5, 70) + "\n" + words(5, 70), "a b \U0001f600 été", "x" * 300_000]
    out = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, None, 1, "x", "y", "z") for i, t in enumerate(texts)]
    return [*out, out[5], out[5], (None, words(1, 60), None, None, None, None, None, None, None), (None, None, None, "s9", None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
