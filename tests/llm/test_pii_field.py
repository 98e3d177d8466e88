"""The field at production weights: clean repeats, consistent labels, enumeration, long logs."""

from __future__ import annotations

import random
import resource
from itertools import product

import numpy as np
import pyarrow.parquet as pq
import pytest

from ratewatch.llm import pii

CLEAN = ["2024", "12.05.2024", "10,000", "covid19", "8837465521", "1999-2000", "v2.10.4", "order#88374655", "555-38241", "A4"]
REPEATS = [1, 2, 3, 10, 40, 100]


@pytest.fixture(scope="module")
def weights():
    """Fitted on the given documents, as ``train`` does."""
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()
    able = [t for t in texts if t and len(t) <= pii.SAMPLE_CHARS and any(c.isdigit() or c == "@" for c in t)]
    return pii.fit(able[: pii.SAMPLE_DOCUMENTS])


def repeated(token, n):
    return " ".join([f"word text {token} and so."] * n)


def added(text, weights):
    base, every = (s[0] for s in pii.spans_of([text], weights))
    return [(text[s:e], pii.KINDS[k]) for s, k, e in every if (s, k, e) not in base]


@pytest.mark.parametrize("n", REPEATS)
@pytest.mark.parametrize("token", CLEAN)
def test_clean_tokens_stay_clean_however_often_they_repeat(weights, token, n):
    assert added(repeated(token, n), weights) == []
    assert added("Call +1 (743) 555-3824 now. " + repeated(token, n), weights) == []


@pytest.mark.parametrize("n", REPEATS)
def test_years_in_prose_and_inside_numbers_stay_clean(weights, n):
    assert added("Revenue in 2023 grew, costs 2023 fell, plan 2023 held, 2023 strong. " * n, weights) == []
    assert added("Call +49 2024 555 3824 now. " + repeated("2024 and 555", n), weights) == []


@pytest.mark.parametrize("n", REPEATS)
def test_every_repeat_of_an_entity_has_its_kind(weights, n):
    call = "Call +1 (743) 555-3824 now."
    for text in (f"{call} {repeated('7435553824', n)}", f"{repeated('7435553824', n)} {call}"):
        assert added(text, weights) == [("7435553824", "phone")] * n
    mixed = f"{call} {repeated('743-555-3824 in 2024 for 10,000 or 8837465521', n)}"
    assert added(mixed, weights) == [("743-555-3824", "phone")] * n
    assert added(f"Mail joe.smith19@mail5.example.com now. {repeated('joe.smith19', n)}", weights) == [("joe.smith19", "email")] * n
    assert added(f"Pay 4785 3805 9239 1139 now. {repeated('4785.3805.9239.1139', n)}", weights) == [("4785.3805.9239.1139", "card")] * n


def test_nothing_is_added_to_the_given_documents_without_evidence(weights):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    for text, base, every in zip(texts, *pii.spans_of([t or "" for t in texts], weights), strict=True):
        kinds = {k for _, k, _ in base}
        assert {k for _, k, _ in every} == kinds, text


def enumerated(g, weights):
    """Marginals by the sum over all labellings."""
    unary = np.hstack([g.seen, g.shape]) @ weights.unary + g.direct @ weights.skip + g.beside[:, None] * weights.chain[0]
    unary[~g.able] = -50
    for i in np.flatnonzero(g.seen.any(axis=1)):
        unary[i] = -50
        unary[i, g.seen[i].argmax() + 1] = 0
    n = len(unary)
    total, scores = np.zeros_like(unary), []
    labellings = [y for y in product(range(unary.shape[1]), repeat=n) if all(unary[i, y[i]] > -40 for i in range(n))]
    for y in labellings:
        scores.append(
            sum(unary[i, y[i]] for i in range(n))
            + sum(weights.chain[y[a], y[b]] for a, b in g.chain)
            + sum(weights.skip[y[a], y[b]] for a, b in g.skip)
        )
    p = np.exp(np.array(scores) - max(scores))
    for y, q in zip(labellings, p / p.sum(), strict=True):
        for i in range(n):
            total[i, y[i]] += q
    return total


LOOPY = [
    "Call +1 (743) 555-3824 or 7435553824 then 743-555-3824, 7435553824.",
    "joe.smith19@mail5.example.com joe.smith19 and joe.smith19 but 5551234567 or joe.smith19",
    "x 4785 3805 9239 1139 and 4785.3805.9239.1139 4785.3805.9239.1139",
]


@pytest.mark.parametrize("text", LOOPY)
def test_loopy_marginals_match_enumeration(weights, text):
    g = pii.graph([text], [pii.base_spans(text)], connected=True)
    assert len(g.skip) + len(g.chain) >= len(g.spans) - 1
    assert np.allclose(pii.marginals(g, weights), enumerated(g, weights), atol=0.02)


def test_loopy_marginals_of_weak_links_match_enumeration():
    rng = np.random.default_rng(4)
    text = "11112222 33334444 11112222 55556666 33334444 11112222"
    g = pii.graph([text], [[]])
    assert len(g.skip) >= 3 and len(g.chain) == 5
    for _ in range(20):
        weak = pii.Weights(rng.normal(0, 1, (len(pii.KINDS) + pii.SHAPES, 5)), np.zeros((5, 5)), np.zeros((5, 5)))
        weak.chain[:], weak.skip[:] = 0.3 * np.eye(5), 0.5 * np.eye(5)
        assert np.allclose(pii.marginals(g, weak), enumerated(g, weak), atol=0.02)


def test_only_connected_tokens_enter_the_graph():
    text = "Call +1 (743) 555-3824 now. " + repeated("2024 8837465521 covid19", 500) + " 7435553824"
    g = pii.graph([text], [pii.base_spans(text)], connected=True)
    assert len(g.spans) == 4 and g.able.sum(axis=1).tolist() == [2] * 4
    assert len(pii.graph([text.replace("+", "")], [[]], connected=True).spans) == 0


def test_a_long_log_takes_bounded_memory(weights):
    rng = random.Random(1)
    lines = [
        f"2024-01-{rng.randint(1, 28):02d} user{rng.randint(1, 400)} id {rng.randint(10**9, 10**10)} from 10.{rng.randint(0, 9)}.3.4"
        f" port {rng.randint(1, 9999)} call +1 (743) 555-{rng.randint(0, 50):04d}\n"
        for _ in range(25_000)
    ]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    text = "".join(lines)[: 2 << 20]
    base, every = pii.spans_of([text], weights)
    assert len(base[0]) > 40_000 and len(every[0]) >= len(base[0])
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 500


def test_a_sample_of_few_candidates_is_found_by_a_wider_look(spark, documents):
    rows = [(i, f"mail a{i}@b.cd" if i % 40 == 0 else "plain words only") for i in range(4000)]
    frame = documents(rows)
    able = frame.where("text like '%@%'").selectExpr("doc_id as _id", "text as _text")
    from pyspark.sql import functions as F

    from ratewatch.llm.common import first_by_hash

    found = first_by_hash(able, "pii", F.col("_id"), 60, 4000, ["_text"], times=1)
    ordered = able.withColumn("_order", F.xxhash64(F.lit("pii"), "_id")).orderBy("_order").limit(60)
    assert found["_id"].to_pylist() == [r["_id"] for r in ordered.collect()]
