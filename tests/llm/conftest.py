from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
LONG = " ".join(WORDS[i * 7 % 17] + str(i % 89) for i in range(3_000))
NEAR = " ".join(LONG.split()[:400])
EDGES = [
    (1, NEAR, "en", "a"),
    (2, NEAR, "en", "a"),
    (3, NEAR.replace("beta22", "changed"), "en", None),
    (3, NEAR.replace("beta22", "changed"), "en", None),
    (4, None, "en", "a"),
    (5, "", None, "b"),
    (None, "one two three four five six seven", None, "b"),
    (None, "one two three four five six seven", None, "b"),
    (6, LONG, "de", "b"),
    (7, " \t\n ", "de", "c"),
    (8, "12345 !!! 678", None, None),
    (9, "È, é; token: \"aB3xK9qLmZ2vT7pW\" \U0001f600 0123456789abcdef0 x", "fr", "c"),
    (10, "two words", "fr", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows, clashing names."""
    frame = spark.createDataFrame(EDGES, SCHEMA).repartition(3)
    names = "id score content hits ref n size shard word query base runs n_chars key component".split()
    return frame.selectExpr("*", *(f"'{name}' AS {name}" for name in names))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 11)] + [(None, 1, 0), (2, 1, 1), (3, None, None), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
