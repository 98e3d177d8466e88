from __future__ import annotations

import random
import string

import pytest

LETTERS = string.ascii_letters + "éßñ0123456789"


@pytest.fixture
def prose():
    """Seeded sentences of invented words."""

    def make(seed: int, words: int) -> str:
        rng = random.Random(seed)
        out = []
        for i in range(words):
            word = "".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8)))
            out.append(word + ("." if i % 9 == 8 else ""))
        return " ".join(out)

    return make


@pytest.fixture
def documents(spark):
    """A frame of documents; rows are id, text and, if given, source. There are columns with awkward names."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1]), 7, "x") for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, size int, ids string"
        return spark.createDataFrame(full, schema)

    return make
