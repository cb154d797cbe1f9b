"""Fixtures that make documents and texts; imported by name."""

from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (id, text) or (id, text, source) tuples."""
    def make(rows, source="s"):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else source, len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded texts over a small vocabulary."""
    def make(n, words, seed=1, vocabulary=400):
        rng = random.Random(seed)
        names = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
        return [" ".join(rng.choice(names) for _ in range(words)) for _ in range(n)]

    return make
