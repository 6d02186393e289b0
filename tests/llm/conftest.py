import random

import pytest


@pytest.fixture(scope="session")
def words():
    """A maker of random texts: words(rng, n) gives n words."""
    pool = [f"w{i}" for i in range(4000)]

    def make(rng: random.Random, n: int) -> str:
        return " ".join(rng.choices(pool, k=n))

    return make


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        full = [(*r, *[None] * (5 - len(r))) if len(r) < 5 else r for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


EDGE = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None), (4, "one", "en", "b", 3), (4, "one", "en", "b", 3),
    (None, "one two three four five six", "en", "c", 27), (None, None, None, None, None), (5, "é ß <|endoftext|> \x1f x", "fr", "d", 9),
    (6, "long " * 30000, "en", "a", 150000), (7, "x" * 70000, "en", "a", 70000),
]


@pytest.fixture(scope="session")
def edge(documents):
    """Null ids and texts, empty, blank, repeated and very long ones."""
    return documents(EDGE)
