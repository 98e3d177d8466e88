"""Mixing sources: targets by rational arithmetic, shards and totals of whole mixes."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from ratewatch.llm import mixing


def plain_targets(sizes, weights):
    out, total, going = {}, Fraction(sum(sizes)), set(range(len(sizes)))
    while going:
        share = {i: total * weights[i] / sum(weights[j] for j in going) for i in going}
        over = [i for i in going if share[i] > 3 * sizes[i]]
        if not over:
            return [out.get(i, share.get(i)) for i in range(len(sizes))]
        for i in over:
            out[i] = Fraction(3 * sizes[i])
            total -= 3 * sizes[i]
            going.remove(i)
    return [out[i] for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(20))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 1000, 10**7]) * rng.randint(1, 9) for _ in range(rng.randint(1, 12))]
    weights = mixing.weights(len(sizes))
    got = mixing.targets(sizes, weights)
    assert np.allclose(got, [float(x) for x in plain_targets(sizes, weights)])
    assert all(g <= 3 * s for g, s in zip(got, sizes, strict=True))


def test_sources_are_in_code_point_order_null_last():
    names = [s.name for s in mixing.plan([("b", 1), (None, 1), ("a", 1), ("é", 1), ("B", 1), ("", 1), ("\U0001f642", 1), ("�", 1)])]
    assert names == ["", "B", "a", "b", "é", "�", "\U0001f642", None]


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_the_tree_deals_every_block_once(shards):
    drawn = [0, 5, 300, 41, 1000]
    leaves = np.array([mixing.quotas(drawn, shards, s, 3) for s in range(shards)])
    assert leaves.sum(axis=0).tolist() == drawn
    assert np.ptp(leaves.sum(axis=1)) <= shards.bit_length()
    assert (leaves == np.array([mixing.quotas(drawn, shards, s, 3) for s in range(shards)])).all()


def test_a_leaf_has_the_hypergeometric_mean():
    leaves = np.array([mixing.quotas([30, 70], 4, 1, seed)[0] for seed in range(400)])
    assert abs(leaves.mean() - 30 / 4) < 0.35


def corpus(seed=0, most=400):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        source = rng.choice(["a", "a", "a", "b", "c", None, "d"])
        rows.append((i, "w " * rng.randint(0, most), source))
    return rows + [(None, "x y z", "a"), (5, "w w", "b"), (5, "w w", "b"), (900, None, "a"), (901, "", "e")]


def words(text):
    return len((text or "").split())


@pytest.mark.parametrize("block", [200, 1 << 16])
def test_mix(documents, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block)
    rows = corpus()
    got = mixing.mix(documents(rows), shards=5).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += words(text)
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(ordered, mixing.targets([sizes[s] for s in ordered], mixing.weights(len(ordered))), strict=True))
    source_of = {(i, words(t)): s for i, t, s in rows}
    taken = Counter()
    for r in got:
        source = source_of[r["doc_id"], r["size"]]
        assert (r["source_size"], r["target"]) == (sizes[source], pytest.approx(target[source]))
        assert r["taken"] == r["size"] * len(r["units"]) <= 3 * r["size"]
        assert len({u["pass"] for u in r["units"]}) == len(r["units"])
        assert all(0 <= u["shard"] < 5 for u in r["units"])
        taken[source] += r["taken"]
    for source in sizes:
        assert target[source] - (60 if block > 400 else 400) <= taken[source] <= target[source] + 1, source
    again = mixing.mix(documents(rows[::-1]).repartition(7), shards=5).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], str(r["units"]))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_rows_are_the_mix(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 500)
    frame = documents(corpus(1))
    taken = Counter()
    for r in mixing.mix(frame, shards=4).collect():
        taken[r["doc_id"], r["size"]] += len(r["units"])
    out = mixing.mixed(frame, shards=4)
    assert out.columns == frame.columns
    copies = Counter((r["doc_id"], words(r["text"])) for r in out.collect())
    assert copies == +taken


def test_a_shard_lies_in_one_partition(spark, documents):
    from pyspark.sql import functions as F

    frame = documents(corpus(2))
    placed = {(r["doc_id"], u["shard"]) for r in mixing.mix(frame, shards=3).collect() for u in r["units"]}
    parts = defaultdict(set)
    for r in mixing.mixed(frame, shards=3).withColumn("p", F.spark_partition_id()).collect():
        parts[r["doc_id"]].add(r["p"])
    assert set(parts) == {i for i, _ in placed}
    assert all(len(p) <= len({s for j, s in placed if j == i}) for i, p in parts.items())


def test_small_and_empty(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixed(documents([])).count() == 0
    (row,) = mixing.mix(documents([(1, None, None)])).collect()
    assert (row["size"], row["target"], row["taken"], row["units"]) == (0, 0.0, 0, [])
    (row,) = mixing.mix(documents([(1, "one two", "s")])).collect()
    assert (row["target"], row["taken"]) == (2.0, 2)


def test_rows_without_ids_are_drawn_one_by_one(documents):
    rows = [(None, f"w{i} a b c d e f g h i", "ab"[i % 2]) for i in range(400)]
    got = mixing.mix(documents(rows)).collect()
    taken = Counter()
    for r in got:
        taken[r["target"]] += r["taken"]
    assert all(target - 10 <= words <= target + 1 for target, words in taken.items()) and len(taken) == 2


def test_too_many_sources(documents, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="more than 2 sources"):
        mixing.mix(documents([(i, "a", f"s{i}") for i in range(4)]))
