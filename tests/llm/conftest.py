from __future__ import annotations

import random

import pytest

SYLLABLES = ["the", "ña", "or", "ing", "tion", "é", "con", "x", "😀", "Al"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=3)) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(11)


def table(spark, rows, schema="doc_id long, text string, lang string, source string"):
    return spark.createDataFrame(rows, schema)


def as_rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]
