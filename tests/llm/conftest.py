from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(20, 120))) for _ in range(n)]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents out of (id, text) pairs, with columns whose names clash with the operators' own."""

    def make(pairs, sources=("b", "a", None)):
        rows = [(i, t, "en", sources[k % len(sources)], None if t is None else len(t)) for k, (i, t) in enumerate(pairs)]
        docs = spark.createDataFrame(rows, SCHEMA)
        clash = ("row", "digest", "id", "mark", "node", "fp", "label", "size", "taken", "spans", "bucket", "line", "batch", "words", "_text", "key")
        return docs.withColumns({c: F.lit(f"other {c}") for c in clash})

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null and repeated ids, null, empty and blank texts, equal rows, a very long text, odd characters."""
    long = " ".join(f"long{i % 977} tail{i % 13}" for i in range(60_000))
    return [
        (None, None), (None, "a b c d e"), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (4, "two other words here"),
        (5, long), (6, long + " end"), (7, "Straße ÀÉ   x y \U0001f600 İ"), (8, "NUL\x00byte and\x0bvertical"), (-9, "a b c d e"),
    ]
