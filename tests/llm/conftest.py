"""Fixtures of odd documents that every operator must take."""

import pytest

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, fp STRING, row STRING, score STRING"


def words(n, seed):
    return " ".join(f"w{(i * 7919 + seed * 104729) % 99991}" for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, repeated rows, clashing column names."""
    long = words(30_000, 1)
    rows = [
        (1, words(40, 2), "en", "a"),
        (2, words(40, 2), "en", "a"),
        (3, None, "en", "a"),
        (4, "", "fr", None),
        (5, " \t\n", None, "b"),
        (6, long, "en", "b"),
        (6, long, "en", "b"),
        (7, long + " tail", "en", "b"),
        (None, "no id at all here", None, None),
        (None, "no id at all here", None, None),
        (8, "ONE", "de", "c"),
        (9, "éà \U0001f600 中文 x", "fr", "c"),
        (10, "x" * 100_000, "de", "c"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), "f", "r", "s") for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
