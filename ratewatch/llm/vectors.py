"""What the vector searches share: usable vectors, a fitted sample, packed blocks, a grid of queries and blocks.

Queries and rows meet as blocks: every chunk of queries meets every block once, in a
grid of lanes, so neither side is sent whole to one place and no pair of rows becomes
a row of a join. What a pair of blocks yields is a few best rows for each query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.llm.common import first_by_hash

#: Rows that centres and first bounds are fitted on, and rows of a packed block or chunk.
SAMPLE, BLOCK, CHUNK = 4096, 8192, 8192
#: Lanes of the grid.
LANES = 48


def usable(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` (long) and ``v`` (floats or doubles) of the rows whose id and vector hold only finite numbers."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = frame.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    kind = "float" if frame.schema[vector_col].dataType.elementType.simpleString() == "float" else "double"
    return rows.select(F.col(id_col).cast("long").alias("id"), v.cast(f"array<{kind}>").alias("v"))


def usual_size(rows: DataFrame) -> int:
    """The most frequent number of components; the larger of equals, 0 without rows."""
    counted = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = counted.orderBy(F.desc("n"), F.desc("d")).first()
    return most["d"] if most else 0


def matrix(column: pa.ListArray | pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def sample(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the ``SAMPLE`` rows that come first by a hash of their id."""
    first = first_by_hash(rows, "sample", F.col("id"), SAMPLE, rows.count(), ["id", "v"])
    return first["id"].to_numpy(), matrix(first["v"], size).astype(float)


def centres(points: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """k-means centres of the sample, begun at evenly placed points; fewer if points are few."""
    centre = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)].copy()
    for _ in range(rounds):
        nearest = squares(points, centre).argmin(axis=1)
        for c in range(len(centre)):
            if (nearest == c).any():
                centre[c] = points[nearest == c].mean(axis=0)
    return np.unique(centre, axis=0)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of the few rows of ``b``."""
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T, 0)


def packed(rows: DataFrame, size: int, kind: str, assign: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Blocks of at most ``BLOCK`` rows of one list, in order of their key: ``list``, ``ids``, ``keys``, ``vectors``.

    ``assign`` gives list and key of vectors. Rows are dealt by ranges of list,
    key and id, so a list of any length is spread over partitions.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, key = assign(matrix(batch.column("v"), size).astype(float))
            columns = [batch.column("id"), batch.column("v"), pa.array(number, pa.int32()), pa.array(key, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "list", "key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = None, ["list", "ids", "keys", "vectors"]

        def block(rows: pa.Table) -> pa.RecordBatch:
            raw = [rows["id"].to_numpy().astype(np.int64), rows["key"].to_numpy(), np.ascontiguousarray(matrix(rows["v"], size))]
            return pa.RecordBatch.from_arrays(
                [pa.array([rows["list"][0].as_py()], pa.int32()), *[pa.array([r.tobytes()], pa.binary()) for r in raw]], names
            )

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, rows]) if held is not None else rows
            while held.num_rows:
                number = held["list"].to_numpy()
                end = min(int(np.searchsorted(number, number[0], side="right")), BLOCK)
                if end == held.num_rows and end < BLOCK:
                    break
                yield block(held.slice(0, end))
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield block(held)

    listed = rows.mapInArrow(keyed, f"id bigint, v array<{kind}>, list int, key double")
    ordered = listed.repartitionByRange("list", "key", "id").sortWithinPartitions("list", "key", "id")
    return ordered.mapInArrow(pack, "list int, ids binary, keys binary, vectors binary")


def searched(
    blocks: DataFrame, queries: DataFrame, size: int, kind: str, score: str, scan: Callable[[np.ndarray, np.ndarray], Callable]
) -> DataFrame:
    """``query_id``, ``vec_id`` and ``score`` (of that type) of what scanners find.

    ``scan(ids, vectors)`` makes a scanner for a chunk of queries. It is called
    with every block (list, ids, keys, vectors) and gives positions of queries,
    ids and scores.
    """
    chunks = max(1, -(-queries.count() // CHUNK))
    dtype = np.float32 if kind == "float" else np.float64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pa.Table.from_batches([batch]) for batch in batches if batch.num_rows]
        rows = pa.concat_tables(held).sort_by([("chunk", "ascending"), ("id", "ascending")]) if held else None
        for c in np.unique(rows["chunk"].to_numpy()) if held else []:
            own = rows.filter(pc.equal(rows["chunk"], int(c)))
            raw = [own["id"].to_numpy().astype(np.int64), np.ascontiguousarray(matrix(own["v"], size))]
            columns = [pa.array([c], pa.int32()), *[pa.array([r.tobytes()], pa.binary()) for r in raw]]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "query_ids", "query_vectors"])

    # A chunk holds about CHUNK queries by its hash, and is packed in one partition.
    dealt = queries.withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "id"), F.lit(chunks)).cast("int"))
    chunked = dealt.repartition(chunks, "chunk").mapInArrow(pack, "chunk int, query_ids binary, query_vectors binary")
    chunked = chunked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    laned = blocks.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(LANES)).cast("int"))
    laned = laned.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, scanner = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                if current != row["chunk"].as_py():
                    current = row["chunk"].as_py()
                    ids = np.frombuffer(row["query_ids"].as_py(), np.int64)
                    scanner = scan(ids, np.frombuffer(row["query_vectors"].as_py(), dtype).reshape(-1, size).astype(float))
                at, found, scores = scanner(
                    row["list"].as_py(),
                    np.frombuffer(row["ids"].as_py(), np.int64),
                    np.frombuffer(row["keys"].as_py(), np.float64),
                    np.frombuffer(row["vectors"].as_py(), dtype).reshape(-1, size).astype(float),
                )
                columns = [pa.array(ids[at], pa.int64()), pa.array(found, pa.int64()), pa.array(scores, kinds[score])]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    kinds = {"double": pa.float64(), "bigint": pa.int64()}
    return laned.join(chunked, ["lane", "chunk"]).drop("lane").mapInArrow(run, f"query_id bigint, vec_id bigint, score {score}")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of every query, ties to the smaller id: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")


def queries_of(rows: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``; of rows with the same id, the smallest vector."""
    return rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th largest of each row, minus infinity where a row has fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return -np.partition(-scores, k - 1, axis=1)[:, k - 1]
