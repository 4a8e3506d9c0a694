import random

import pytest

DIR = "/root/testdata/sf0.001"
# names that operators might use themselves
CLASHES = ("id", "n", "key", "size", "score", "kept", "block", "hash", "spans", "fp", "ids", "ref")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated ids and rows, columns with clashing names."""
    random.seed(3)
    vocabulary = ["".join(random.choices("abcdefghij", k=random.randint(2, 8))) for _ in range(400)]
    body = " ".join(random.choices(vocabulary, k=120))
    rows = [(1, "same  text\there and there"), (1, "same text here and there"), (2, "same text here and there"), (None, None),
            (None, "same text here and there"), (3, ""), (4, None), (5, " \n "), (6, body), (7, body + " more"), (6, body),
            (8, " ".join(random.choices(vocabulary, k=30_000))), (9, "x"), (10, "é ß 漢字 \U0001F600 Σς İ"), (-5, "a\x00b\x1cc"),
            (11, "z" * 5000), (12, "under the MIT license, token = abcdefgh1234")]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(i, t, None, *["q"] * len(CLASHES)) for i, t in rows], schema).repartition(4)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


def rows_of(df, key=repr):
    return sorted((tuple(r) for r in df.collect()), key=key)
