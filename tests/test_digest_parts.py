"""Messages split at the limit: whole lines where they fit, nothing lost."""

from __future__ import annotations

import random

import pytest

from ratewatch.operators.digest import digest_document, split_messages
from ratewatch import Clock


def plain(message, limit):
    parts = []
    for line in message.split("\n"):
        for at in range(max(len(line) - 1, 0) // limit + 1):
            text = line[at * limit : (at + 1) * limit]
            if parts and at == 0 and len(parts[-1][0]) + 1 + len(text) <= limit:
                parts[-1] = (f"{parts[-1][0]}\n{text}", parts[-1][1])
            else:
                parts.append((text, at > 0))
    return parts


@pytest.mark.parametrize("limit", [1, 7, 40, 5000])
def test_parts_fit_and_join_to_the_message(spark, limit):
    rng = random.Random(limit)
    signs = "ab \n💳é|"
    messages = ["", "\n", "\n\n\n", "one line", "x" * (12_000 if limit > 7 else 300), *("".join(rng.choice(signs) for _ in range(rng.randint(0, 300))) for _ in range(30))]
    messages.append("\n".join(f"• `pc_{i}` | {'long ' * rng.randint(0, 40)}" for i in range(400 if limit > 7 else 20)))
    frame = spark.createDataFrame([(i, m, len(m), True) for i, m in enumerate(messages)], "position int, message string, length int, fits boolean")
    rows = split_messages(frame, limit).orderBy("position", "part").collect()
    assert all(r.fits and r.length == len(r.message) <= limit for r in rows)
    for i, message in enumerate(messages):
        own = [r for r in rows if r.position == i]
        assert [r.part for r in own] == list(range(1, len(own) + 1))
        assert [(r.message, r.continues) for r in own] == plain(message, limit)
        text = own[0].message
        for r in own[1:]:
            text += r.message if r.continues else f"\n{r.message}"
        assert text == message


def test_document_of_parts(spark):
    frame = spark.createDataFrame([(1, "c\nd" * 9), (0, "a\nb")], "position int, message string")
    (row,) = digest_document(split_messages(frame, 12), Clock.at("2024-01-31")).collect()
    assert row["messages"][0] == "a\nb" and len(row["messages"]) > 3
    with pytest.raises(ValueError):
        split_messages(frame, 0)
