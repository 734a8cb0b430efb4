import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or longer tuples."""

    def build(*rows):
        filled = [(*r, *(None,) * (5 - len(r))) for r in rows]
        return spark.createDataFrame(filled, DOCS)

    return build


@pytest.fixture(scope="session")
def prose():
    """Random words with a seed: prose(n, seed) is a text of n words."""

    def make(n, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))

    return make
