"""Operator 4: approximate nearest neighbours by adaptive dimension scan.

Vectors lie in the lists of k-means centres fitted on a bounded sample; every vector
is indexed. A query probes its ``PROBES`` nearest of ``LISTS`` lists. Within a list,
vectors are compared in column blocks of a random rotation: after each block, the
partial squared distance, scaled up to all columns, is tested against the distance
of the query's k-th best so far. A candidate that fails the test at the given
significance is abandoned; what remains is scored exactly on the original vectors. The first
bound comes from the sample's rows in probed lists; those that set it are never abandoned, so
a query finds ``k`` rows wherever its lists hold them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.llm import vectors as V

#: Lists, lists probed, columns of a block, and standard errors that a partial distance may be short by.
LISTS, PROBES, COLUMNS, ERRORS = 64, 42, 16, 2.1
#: What rounding may add to a squared distance of unit vectors.
SLACK = 1e-6


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by a power of two against overflow, and their lengths."""
    _, power = np.frexp(np.abs(x).max(axis=1, initial=0))
    scaled = np.ldexp(x, -power[:, None])
    return scaled, np.sqrt((scaled**2).sum(axis=1))


def nearest(
    frame: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 23
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (cosine) of the ``k`` nearest found.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but those with the query's id. Nearest first, ties to the smaller id.
    Vectors that are null, empty, zero, or hold null or non-finite components,
    rows with a null id, and vectors of another than the usual number of
    components take no part. Of queries with the same id the smallest vector
    counts; candidates may repeat. Further columns are not read. An empty table
    gives an empty result.
    """
    rows = V.usable(frame, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    size = V.usual_size(rows)
    kind = rows.schema["v"].dataType.elementType.simpleString()
    if not size:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("v") == size)
    sample_ids, points = V.sample(rows, size)
    scaled, length = unit(points)
    points = scaled / length[:, None]
    centre = V.centres(points, LISTS)
    away = V.squares(points, centre)
    # Distances are rounded, so a sample row may lie in any list that is nearest up to that.
    lists = (away <= away.min(axis=1, keepdims=True) + SLACK).astype(np.float32)
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]

    def assign(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled, length = unit(x)
        distance = V.squares(scaled / length[:, None], centre)
        number = distance.argmin(axis=1)
        return number, distance[np.arange(len(x)), number]

    def scan(ids: np.ndarray, queries: np.ndarray):
        scaled, length = unit(queries)
        units = scaled / length[:, None]
        turned = units @ turn
        probed = np.zeros((len(ids), len(centre)), dtype=bool)
        np.put_along_axis(probed, V.squares(units, centre).argsort(axis=1, kind="stable")[:, :PROBES], True, axis=1)
        best = np.full((len(ids), k), -np.inf)
        bound = np.full(len(ids), -np.inf)
        certain = np.empty((len(ids), min(k, len(points))), dtype=np.int64)
        for at in range(0, len(ids), 256):
            cosine = units[at : at + 256] @ points.T
            cosine[ids[at : at + 256, None] == sample_ids] = -np.inf
            cosine[(~probed[at : at + 256]).astype(np.float32) @ lists.T > 0] = -np.inf
            bound[at : at + 256] = V.kth_best(cosine, k)
            certain[at : at + 256] = sample_ids[np.argpartition(-cosine, certain.shape[1] - 1, axis=1)[:, : certain.shape[1]]]

        def scanner(number: int, own: np.ndarray, _: np.ndarray, x: np.ndarray):
            rows, lengths = unit(x)
            columns = (rows / lengths[:, None]) @ turn
            parts = [columns[:, c : c + COLUMNS] for c in range(0, size, COLUMNS)]
            here = np.isin(certain, own).any(axis=1)
            out = [], [], []
            for q in np.flatnonzero(probed[:, number]):
                radius = 2 - 2 * bound[q] if np.isfinite(bound[q]) else np.inf
                alive, partial, seen = np.flatnonzero(own != ids[q]), 0.0, 0
                kept = np.isin(own, certain[q]) if here[q] else None
                for part in parts:
                    seen += part.shape[1]
                    partial = partial + ((part[alive] - turned[q, seen - part.shape[1] : seen]) ** 2).sum(axis=1)
                    if seen < size:
                        allowed = radius * seen / size * (1 + ERRORS / np.sqrt(seen)) ** 2
                    else:
                        allowed = radius
                    keep = partial <= allowed + SLACK
                    if kept is not None:
                        keep |= kept[alive]
                    alive, partial = alive[keep], partial[keep]
                if not len(alive):
                    continue
                score = (rows[alive] * scaled[q]).sum(axis=1) / (lengths[alive] * length[q])
                order = np.lexsort((own[alive], -score))[:k]
                out[0].extend([q] * len(order))
                out[1].extend(own[alive[order]].tolist())
                out[2].extend(score[order].tolist())
                best[q] = -np.sort(-np.append(best[q], score[order]))[:k]
                bound[q] = max(bound[q], best[q, -1])
            return np.array(out[0], dtype=np.int64), out[1], out[2]

        return scanner

    blocks = V.packed(rows, size, kind, assign)
    found = V.searched(blocks, V.queries_of(rows, every), size, kind, "double", scan)
    return V.ranked(found, k)
