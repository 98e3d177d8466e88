"""Operator 6: exact top-k inner products by a pivot-distance index.

Components become whole numbers. Every vector is keyed by its nearest pivot and its
distance from it; a list's vectors lie in order of distance, in annuli of ``ANNULUS``.
By the triangle inequality, a query at distance d from the pivot is at least the gap
between d and an annulus away from all vectors in it, so with
2 q.x = |q|^2 + |x|^2 - |q - x|^2 no score in it exceeds half of |q|^2 + max |x|^2 - gap^2.
A query expands its annuli outwards from its own distance and stops at the first ring
whose bound cannot reach its k-th best score so far; a score equal to it is
still looked at, for the smaller id. The first k-th best comes from a sample whose rows
are candidates themselves. Bounds only skip what cannot count: the result is exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.llm import vectors as V

#: Pivots, and vectors of an annulus.
PIVOTS, ANNULUS = 32, 256
SCALE = 1024


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: as doubles if these are exact, else as Python numbers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return a @ b.T
    x, y = (np.array([[int(c) for c in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b))
    return x @ y.T


def longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and any(abs(x) >= 2**63 for x in scores):
        raise ValueError("an inner product does not fit a long")
    return scores.astype(np.int64)


def lowered(bound: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(bound), bound - np.abs(bound) * 1e-12, bound)


def firsts(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Where the ``k`` highest scores of every query are, ties to the smaller id, in order of the query."""
    order = np.lexsort((ids, -scores, at))
    sorted_at = at[order]
    return order[np.arange(len(at)) - np.searchsorted(sorted_at, sorted_at) < k]


def top_products(
    frame: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (long) of the ``k`` highest scores of every query.

    A component x counts as floor(1024 x). Queries are the rows whose id is
    divisible by ``every``; candidates are all rows but those with the query's
    id; ties go to the smaller id. Vectors that are null, empty, or hold null or
    non-finite components, rows with a null id, and vectors of another than the
    usual number of components take no part. Of queries with the same id the
    smallest vector counts; candidates may repeat. A score beyond a long raises
    ValueError. Further columns are not read. An empty table gives an empty
    result.
    """
    rows = V.usable(frame, id_col, vector_col)
    size = V.usual_size(rows)
    kind = rows.schema["v"].dataType.elementType.simpleString()
    if not size:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rows = rows.where(F.size("v") == size)
    sample_ids, points = V.sample(rows, size)
    points = np.floor(points * SCALE)
    pivots = V.centres(points, PIVOTS)

    def assign(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distance = np.sqrt(V.squares(np.floor(x * SCALE), pivots))
        number = distance.argmin(axis=1)
        return number, distance[np.arange(len(x)), number]

    def scan(ids: np.ndarray, queries: np.ndarray):
        whole = np.floor(queries * SCALE)
        norms, away = (whole**2).sum(axis=1), np.sqrt(V.squares(whole, pivots))
        least = np.full(len(ids), -np.inf)
        for at in range(0, len(ids), 256):
            scores = products(whole[at : at + 256], points).astype(float)
            scores[ids[at : at + 256, None] == sample_ids] = -np.inf
            least[at : at + 256] = V.kth_best(scores, k)
        best = np.repeat(np.full((1, k), -np.inf), len(ids), axis=0)

        def scanner(number: int, own: np.ndarray, keys: np.ndarray, x: np.ndarray):
            x = np.floor(x * SCALE)
            largest = (x**2).sum(axis=1)
            starts = np.arange(0, len(own), ANNULUS)
            ends = np.append(starts[1:], len(own))
            gaps = np.maximum(keys[starts] - away[:, number, None], away[:, number, None] - keys[ends - 1])
            # Distances are rounded, so gaps are taken a little shorter than they are.
            gaps = np.maximum(gaps - 1e-6 * (1 + away[:, number, None] + keys[-1]), 0)
            rings = gaps.argsort(axis=1, kind="stable")
            reach = (norms[:, None] + largest.max() - np.take_along_axis(gaps, rings, axis=1) ** 2) / 2
            reach = reach + 1e-9 * np.abs(reach) + 1
            out = [], [], []
            going = np.arange(len(ids))
            for ring in range(len(starts)):
                going = going[reach[going, ring] >= least[going]]
                if not len(going):
                    break
                for annulus in np.unique(rings[going, ring]):
                    near = going[rings[going, ring] == annulus]
                    rows = slice(starts[annulus], ends[annulus])
                    scores = products(whole[near], x[rows])
                    # Beyond 2^53 the bound is rounded; a score that comes near it stays.
                    hit = (scores >= lowered(least[near])[:, None]).astype(bool) & (own[rows] != ids[near, None])
                    at, column = np.nonzero(hit)
                    if not len(at):
                        continue
                    found, others = longs(scores[at, column]), own[rows][column]
                    # Copies tie with the k-th score, so a query keeps no more than k of an annulus and of a block.
                    kept = firsts(at, others, found, k)
                    at, found = at[kept], found[kept]
                    out[0].append(near[at])
                    out[1].append(others[kept])
                    out[2].append(found)
                    for q, values in zip(near, np.split(found, np.searchsorted(at, np.arange(1, len(near)))), strict=True):
                        if len(values):
                            best[q] = -np.sort(-np.append(best[q], values))[:k]
                            least[q] = max(least[q], best[q, -1])
            if not out[0]:
                return np.empty(0, np.int64), [], []
            at, found, scores = (np.concatenate(o) for o in out)
            keep = firsts(at, found, scores, k)
            keep = keep[scores[keep] >= lowered(least[at[keep]])]
            return at[keep], found[keep], scores[keep]

        return scanner

    blocks = V.packed(rows, size, kind, assign)
    found = V.searched(blocks, V.queries_of(rows, every), size, kind, "bigint", scan)
    return V.ranked(found, k)
