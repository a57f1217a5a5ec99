"""Awkward documents: nulls in every column, empty, blank and long texts, ties, repeated rows, and
extra columns whose names clash with those that operators make."""

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *(T.StructField(n, T.IntegerType()) for n in ("size", "kept", "fp", "key", "root", "pattern", "spans", "epochs",
                                                  "Fingerprint", "mix_id", "text_hash", "rank", "copies", "u"))])


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["the", "river", "stone", "walks", "under", "quiet", "light", "and", "before", "garden", "ocean", "letter",
             "morning", "winter", "carries", "small", "table", "green", "window", "answer", "music", "of", "in", "to"]
    words += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n // 2)]
    return " ".join(rng.choice(words) for _ in range(n))


def awkward_rows() -> list[tuple]:
    base = [(1, prose(1, 120), "en", "b"), (2, prose(2, 300), "en", "a"), (3, None, "de", "a"), (4, "", None, None),
            (5, " \t\n\r ", "fr", "b"), (None, prose(3, 80), "en", None), (None, None, None, None),
            (7, "word " * 200, "en", "a"), (8, prose(1, 120), "en", "a"), (8, prose(1, 120), "en", "a"),
            (9, prose(4, 30_000), "de", "c"), (10, "Tab\tand\x0bvertical\x0cfeed é Σ ΑΣ İ  \x1c x", "es", "c"),
            (11, "one", "en", "c"), (12, "one two", "en", None), (13, "ONE TWO", "en", "b"),
            (14, "x" * 50_000, "en", "b"), (15, "password = hunter2222 token: zzzzzz AKIA" + "A1" * 10, "en", "a"),
            (16, "line\nline\n \nline\n" + prose(5, 90), "de", "d"), (17, prose(6, 64) + " end", "en", "d")]
    base += [(100 + k, prose(1000 + k, 60 + 5 * k), "de" if k % 2 else "en", "abcd"[k % 4]) for k in range(30)]
    return [(*r, len(r[1]) if r[1] is not None else None, *[None] * 14) for r in base]


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def same(found, expected):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, expected), key=key)
