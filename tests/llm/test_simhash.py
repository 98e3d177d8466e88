"""SimHash near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from ratewatch.llm import simhash
from ratewatch.llm.components import roots


def plain_fingerprint(text: str | None, k: int = 4) -> int:
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], bits: int) -> list[int]:
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_fingerprints_of_awkward_texts(prose):
    texts = ["", " \t\n", "one", "One  TWO", "a b c d", "a b c d e\x0b f ", "Été ÉTÉ \xa0 x y z w", prose(1, 300), "w " * 40_000]
    for text in texts:
        for k in (1, 4, 5):
            assert simhash.fingerprint(text.encode(), k) == plain_fingerprint(text, k), text[:30]


@pytest.mark.parametrize("bits", range(8))
def test_every_close_pair_shares_a_list(bits):
    sets = simhash.position_sets(8 - bits)
    rng = random.Random(bits)
    for _ in range(300):
        flipped = {b // 8 for b in rng.sample(range(64), bits)}
        assert any(not flipped & set(s) for s in sets)


@pytest.mark.parametrize("block", [8, 1024])
def test_components_of_fingerprints(spark, block):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for start in rng.sample(sorted(prints), 12):
        at = start
        for _ in range(20):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                at ^= 1 << b
            prints.add(at)
    prints = sorted(prints)
    want = plain_components(prints, 4)
    signed = [int(x) for x in np.array(prints, dtype=np.uint64).view(np.int64)]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r["node"]: r["root"] for r in roots(simhash.edges(frame, 4, block)).collect()}
    got = [found.get(x, x) for x in signed]
    groups = lambda labels: sorted(sorted(i for i, y in enumerate(labels) if y == x) for x in set(labels))
    assert groups(got) == groups(want)


def test_long_and_short_runs_are_linked_alike():
    rng = np.random.default_rng(0)
    centre = np.uint64(rng.integers(1 << 62))
    near = np.array([centre ^ np.uint64(1 << a) ^ np.uint64(1 << b) for a, b in rng.integers(0, 64, (150, 2))], dtype=np.uint64)
    for count in (2, 40, 150):
        fps = np.unique(near[:count])
        edges = [b for b in simhash._linked(fps.view(np.int64), np.zeros(len(fps), dtype=np.int64), 4)]
        assert sum(e.num_rows for e in edges) == len(fps) - 1


def docs_with_copies(prose):
    base = [prose(i, 120) for i in range(40)]
    rows = [(10 * i, text) for i, text in enumerate(base)]
    rows += [(5, base[3]), (6, base[3].upper()), (7, base[3] + " one"), (400, None), (401, ""), (402, " \n"), (None, base[9])]
    rows += [(30, base[3]), (30, base[3]), (8, prose(99, 3)), (9, prose(99, 3) + "")]
    return rows


def test_documents(documents, prose):
    rows = docs_with_copies(prose)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents(rows)).collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(prints, 4)
    least = {x: min((rows[i][0] for i, y in enumerate(label) if x == y and rows[i][0] is not None), default=None) for x in label}
    want = [(rows[i][0], f"{prints[i]:016x}", least[label[i]]) for i in range(len(rows))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_one_document_of_each_group_stays(documents, prose):
    rows = docs_with_copies(prose)
    frame = documents(rows)
    kept = simhash.representatives(frame)
    assert kept.columns == frame.columns
    prints = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(prints, 4)
    least = {x: min((rows[i][0] for i, y in enumerate(label) if x == y and rows[i][0] is not None), default=None) for x in label}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.representatives(documents([])).count() == 0


def test_chains_and_stars_settle(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(50)] + [(1001, 1001), (1002, 1000), (1003, None)]
    frame = spark.createDataFrame(chain + star, "a long, b long")
    found = {r["node"]: r["root"] for r in roots(frame).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(51)}


def test_bits_beyond_the_index(spark):
    with pytest.raises(ValueError, match="at most 7"):
        simhash.edges(spark.createDataFrame([(1,)], "fp long"), 8)


def test_a_hot_key_is_split(spark):
    from ratewatch.llm.common import split_join

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    rows = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id) AS a", "id AS b")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = split_join(rows, rows.groupBy("a").agg({"b": "min"}), ["a"])
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in plan
