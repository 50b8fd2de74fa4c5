from __future__ import annotations

import random
from collections import Counter

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside
    "label int, score double, key string, bucket string, rank long, size string, n_words string"
)

LONG = " ".join(f"w{i % 5003}" for i in range(60_000))
ODD = [
    (None, "no id but some words here to count"),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, "one"),
    (5, LONG),
    (6, "x" * 200_000),
    (7, "repeated row of words"),
    (7, "repeated row of words"),
    (8, "tie " * 30),
    (9, "tie " * 30),
    (10, "naïve 日本語 😀 ▁ \0 \x85 text"),
    (-11, "negative id"),
]


def prose(seed: int, n: int, words: int = 400) -> str:
    draw = random.Random(seed)
    known = ["".join(draw.choices("abcdefghilmnorstu", k=draw.randint(2, 9))) for _ in range(words)]
    return " ".join(draw.choice(known) for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns of clashing names."""

    def make(rows):
        data = []
        for doc_id, text, *source in rows:
            at = source[0] if source else "s"
            data.append((doc_id, text, "en", at, None, 1, 0.5, "k", "b", 7, "z", "q"))
        return spark.createDataFrame(data, SCHEMA)

    return make


@pytest.fixture(scope="session")
def counted():
    def collect(df, *columns):
        return Counter(tuple(r[c] for c in columns or df.columns) for r in df.collect())

    return collect
