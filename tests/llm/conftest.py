from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int) -> str:
    syllables = "ka lo mi ren tu sal ver dan pek os il mar ent ung ous ble".split()
    return " ".join(
        "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)
    )


def edited(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = prose(rng, 1) + "x"
    return " ".join(words)


@pytest.fixture
def documents(spark):
    """A function from (id, text[, source]) tuples to a documents table."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make
