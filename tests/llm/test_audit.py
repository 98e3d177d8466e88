"""The filter audit against plain loops over documents and orders."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import permutations

import pytest

from ratewatch.llm import audit

SIGNS = " \t\n\x0b\x0c\r\x1c\x85\xa0aAbBZé#|日"


def brute_force(docs, labels):
    """``docs``: id, text, part; ``labels``: id, quality, toxic."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    judged = defaultdict(list)
    for i, text, part in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
            fails.add("E")
        judged[part or ""].append((i, fails))
    rows = []
    for part, members in judged.items():
        own, totals = [], defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            here = list(members)
            for step, letter in enumerate(order, 1):
                gone = [m for m in here if letter in m[1]]
                here = [m for m in here if letter not in m[1]]
                failing = sum(letter in f for _, f in members)
                totals[letter] += len(gone)
                own.append((part, order, step, len(here), len(gone), failing - len(gone), sum(f == {letter} for _, f in members),
                            sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        rows += [(*r, totals[r[1][r[2] - 1]]) for r in own]
    return sorted(rows)


def audited(spark, docs, labels):
    schema = "doc_id long, text string, lang string, mask int, part string, filter int"
    frame = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], schema)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in audit.audit(frame, marks).collect())


def test_against_all_orders(spark):
    rng = random.Random(3)
    docs = []
    for i in range(120):
        words = [rng.choice(["ab", "cd", "Ef", "GH", "x"]) if rng.random() < 0.3 else f"w{rng.randint(0, 900)}" for _ in range(rng.choice([0, 30, 99, 100, 150]))]
        text = rng.choice([" ", "\n", "\t "]).join(words) + rng.choice(["", "", "#", "|"])
        docs.append((rng.choice([i, i, i, None, 7]), text, rng.choice(["en", "de", None, ""])))
    docs += [(1000 + i, t, p) for i, (_, t, p) in enumerate(docs[:50])] + docs[:5] + [(2000, None, "en"), (2001, "", "fr")]
    docs += [(3000 + i, "".join(rng.choice(SIGNS) for _ in range(30)), "en") for i in range(20)]
    labels = [(rng.choice([d[0], None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in docs for _ in range(2)]
    found = audited(spark, docs, labels)
    assert found == brute_force(docs, labels)


def test_a_third_of_the_rows_is_one_text(spark):
    docs = [(i, "same text" if i % 3 == 0 else f"other {i}", "en") for i in range(600)]
    assert audited(spark, docs, []) == brute_force(docs, [])


def test_no_rows(spark):
    assert audited(spark, [], []) == []
    rows = audited(spark, [(1, None, None)], [])
    assert len(rows) == 600 and {r[0] for r in rows} == {""}


@pytest.mark.parametrize(
    ("text", "bits"),
    [
        ("", 1), ("a " * 100, 2), (" ".join(f"w{i}" for i in range(100)), 0), (" ".join(f"w{i}" for i in range(99)), 1),
        ("A" + "b" * 9, 1), ("A" + "b" * 8, 5), ("A" + "é" * 9, 1), ("Ä" * 50, 1), ("100%", 9), ("a\x1cb\x85c", 1),
    ],
)
def test_bounds_of_the_filters(text, bits):
    assert audit.failures(text.encode()) == bits


def test_exactly_four_fifths_distinct_passes():
    words = [f"w{i}" for i in range(80)] + ["w0"] * 20
    assert audit.failures(" ".join(words).encode()) == 0
    assert audit.failures(" ".join([*words, "w0"]).encode()) == 2
