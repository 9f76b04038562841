import random

import pytest


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from shelfline.sources.workspace import let_workers_import

    let_workers_import(spark)
    return spark


@pytest.fixture
def frame(spark):
    """Documents with columns that clash with names the operators use themselves."""

    def make(rows):
        rows = [(i, t, "x", 1, 2.0, "y") for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, key string, place int, score double, component string"
        )

    return make


def random_words(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture
def words():
    return random_words


@pytest.fixture
def odd_rows():
    """Nulls, blanks, repeated rows, ids that are missing, and a very long text."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (4, "one"),
        (5, "two words"),
        (None, "no id here"),
        (None, None),
        (6, " ".join(random_words(1, 30_000))),
        (7, "é" * 5000 + " \x1c  x"),
    ]
