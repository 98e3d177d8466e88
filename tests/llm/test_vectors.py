"""Both vector searches against brute force."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from ratewatch.llm import ann, topk
from ratewatch.llm import vectors as V


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, score string, id int")


def clustered(count, size, seed=0, single=np.float32):
    """Unit vectors; a third lie close together, some repeat."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(count, size))
    x[: count // 3] = x[0] + 0.05 * rng.normal(size=(count // 3, size))
    x[count // 3 + 5] = x[count // 3 + 4]
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(single)


def awkward(size):
    nan, inf = float("nan"), float("inf")
    return [
        (2000, None), (2100, []), (2200, [nan] + [1.0] * (size - 1)), (2300, [inf] * size), (2400, [None] + [1.0] * (size - 1)),
        (2500, [1.0] * (size + 1)), (None, [1.0] * size),
    ]


def cosines(rows, query):
    own = next(v for i, v in rows if i == query)
    out = []
    for i, v in rows:
        if i != query:
            a, b = [float(x) for x in own], [float(x) for x in v]
            out.append((-math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a)) / math.sqrt(math.fsum(x * x for x in b)), i))
    return sorted(out)


def test_nearest(spark):
    x = clustered(1500, 24)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    found = ann.nearest(frame(spark, [*rows, *awkward(24), (2600, [0.0] * 24)])).collect()
    by_query: dict = {}
    for r in found:
        by_query.setdefault(r["query_id"], []).append(r)
    assert set(by_query) == set(range(0, 1500, 50))
    hits = 0
    for query, got in by_query.items():
        got.sort(key=lambda r: r["rank"])
        want = cosines(rows, query)
        exact = {i: -s for s, i in want}
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert all(r["score"] == pytest.approx(exact[r["vec_id"]], abs=1e-12) for r in got)
        assert [(-r["score"], r["vec_id"]) for r in got] == sorted((-r["score"], r["vec_id"]) for r in got)
        hits += len({r["vec_id"] for r in got} & {i for _, i in want[:5]})
    assert hits / (5 * len(by_query)) >= 0.9


def test_ties_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [0.5, 0.0]), (3, [0.5, 0.0]), (50, [0.0, 1e-30])]
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(frame(spark, rows)).collect()}
    assert [got[0, n] for n in (1, 2, 3, 4)] == [(3, 1.0), (3, 1.0), (7, 1.0), (50, 0.0)]
    assert len(got) == 8


def test_large_and_small_doubles(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 1e-200]), (2, [-3.0, -3.0])]
    got = [(r["vec_id"], round(r["score"], 12)) for r in ann.nearest(frame(spark, rows, "double")).collect()]
    assert got == [(1, 1.0), (2, -1.0)]


def test_abandoning_keeps_what_the_lists_hold(spark, monkeypatch):
    """With all lists probed, only the hypothesis test can lose a neighbour."""
    monkeypatch.setattr(ann, "PROBES", 64)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(clustered(1200, 64, 3))]
    found = {(r["query_id"], r["vec_id"]) for r in ann.nearest(frame(spark, rows)).collect()}
    want = {(q, i) for q in range(0, 1200, 50) for _, i in cosines(rows, q)[:5]}
    assert len(found & want) / len(want) >= 0.97


def test_every_query_finds_k_rows(spark):
    """Without clusters, many of the best sample rows lie in lists that are not probed."""
    x = np.random.default_rng(4).normal(size=(2000, 64)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    found = ann.nearest(frame(spark, rows)).collect()
    assert sorted((r["query_id"], r["rank"]) for r in found) == [(q, n) for q in range(0, 2000, 50) for n in range(1, 6)]


def test_rows_that_set_the_bound_are_not_abandoned(spark, monkeypatch):
    """A test that abandons nearly everything still leaves k rows."""
    monkeypatch.setattr(ann, "ERRORS", -3.9)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(np.random.default_rng(5).normal(size=(600, 64)))]
    found = ann.nearest(frame(spark, rows)).collect()
    assert sorted((r["query_id"], r["rank"]) for r in found) == [(q, n) for q in range(0, 600, 50) for n in range(1, 6)]


def products(rows, query, k):
    whole = lambda v: [math.floor(1024 * float(x)) for x in v]
    own = whole(next(v for i, v in rows if i == query))
    scored = sorted((-sum(a * b for a, b in zip(own, whole(v))), i) for i, v in rows if i != query)
    return [(query, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]


@pytest.mark.parametrize("block,annulus", [(8192, 256), (100, 16)])
def test_top_products_are_exact(spark, monkeypatch, block, annulus):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(topk, "ANNULUS", annulus)
    x = clustered(1200, 16, 1) * np.linspace(0.2, 3, 1200, dtype=np.float32)[:, None]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(4000 + i, [0.25] * 16) for i in range(30)] + [(4040, [0.0] * 16)]
    got = topk.top_products(frame(spark, [*rows, *awkward(16)])).collect()
    want = [t for q in [i for i, _ in rows if i % 100 == 0] for t in products(rows, q, 10)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_many_chunks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(V, "CHUNK", 3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(clustered(900, 8, 2))]
    got = topk.top_products(frame(spark, rows), k=3, every=50).collect()
    assert sorted(tuple(r) for r in got) == sorted(t for q in range(0, 900, 50) for t in products(rows, q, 3))


def test_copies_do_not_meet_in_pairs(spark, monkeypatch):
    """Of 3000 copies, a query emits a few of each block, not all others."""
    rows = [(i, [0.5, 0.25]) for i in range(3000)]
    want = [(q, n + 1, i, 327680) for q in range(0, 3000, 50) for n, i in enumerate([i for i in range(11) if i != q][:10])]
    assert sorted(tuple(r) for r in topk.top_products(frame(spark, rows), every=50).collect()) == want
    monkeypatch.setattr(V, "ranked", lambda found, k: found)
    assert topk.top_products(frame(spark, rows), every=50).count() <= 60 * 10 * 20


def test_large_numbers_stay_exact(spark):
    rows = [(0, [3.1e6, 1.0]), (1, [2.8e6, 7.0]), (2, [2.8e6, 7.001]), (3, [-1.0, -1.0]), (100, [2.8e6, 7.002])]
    got = topk.top_products(frame(spark, rows, "double")).collect()
    assert sorted(tuple(r) for r in got) == sorted([*products(rows, 0, 10), *products(rows, 100, 10)])
    big = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0]])
    assert topk.products(*big)[0, 0] == int(Fraction(2) ** 60 + 3)
    with pytest.raises(ValueError, match="does not fit"):
        topk.longs(topk.products(np.array([[2.0**40]]), np.array([[2.0**40]]))[0])


def test_empty_tables(spark):
    for rows in ([], awkward(4)[:5]):
        assert ann.nearest(frame(spark, rows)).count() == 0
        assert topk.top_products(frame(spark, rows)).count() == 0
    assert topk.top_products(frame(spark, [(1, [1.0])])).count() == 0
    assert topk.top_products(frame(spark, [(100, [1.0])])).count() == 0


def test_blocks_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 50)
    rows = V.usable(frame(spark, [(i, [float(c) for c in v]) for i, v in enumerate(clustered(700, 8))]), "vec_id", "embedding")
    assign = lambda x: ((x[:, 0] > 0).astype(int), x[:, 1])
    blocks = V.packed(rows, 8, "float", assign).collect()
    ids = [np.frombuffer(b["ids"], np.int64) for b in blocks]
    assert sorted(np.concatenate(ids).tolist()) == list(range(700)) and max(map(len, ids)) <= 50
    assert all((np.diff(np.frombuffer(b["keys"], float)) >= 0).all() for b in blocks)


def test_the_sample_does_not_depend_on_how_it_is_found(spark):
    from pyspark.sql import functions as F

    from ratewatch.llm.common import first_by_hash

    rows = spark.range(20_000).selectExpr("id", "id % 7 AS v")
    want = rows.withColumn("o", F.xxhash64(F.lit("s"), "id")).orderBy("o").limit(100).toPandas()["id"].tolist()
    for total in (0, 20_000, 10**9):
        found = first_by_hash(rows, "s", F.col("id"), 100, total, ["v"])
        assert found["id"].to_pylist() == want
