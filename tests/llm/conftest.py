from __future__ import annotations

import random

import pytest

from perkline.llm.shipping import ship_library

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, key string, shard string"


@pytest.fixture(scope="session")
def session(spark):
    ship_library(spark)
    return spark


@pytest.fixture(scope="session")
def documents(session):
    """(doc_id, text) pairs as a table with columns whose names clash with those the operators add."""

    def build(pairs, sources=None):
        rows = [
            (d, t, "en", sources[i] if sources else f"s{i % 3}", None if t is None else len(t), "x", "y", "z")
            for i, (d, t) in enumerate(pairs)
        ]
        return session.createDataFrame(rows, DOCS).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, ties, repeated rows, no id, and a very long text."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n \x0b"),
        (4, "word"),
        (5, "word"),
        (6, "One two three four five six."),
        (6, "One two three four five six."),
        (6, "Another text for the same id"),
        (None, "No id at all here\nbut two lines"),
        (None, None),
        (7, long),
        (8, long + " more"),
        (9, "Ünïcode ßtraße ÉCOLE ñandú 東京 text"),
    ]
