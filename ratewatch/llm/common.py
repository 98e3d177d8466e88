"""What several operators need: lineage cuts, bounded slices of Arrow batches, list columns."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a Python task holds in its own structures at a time; a longer text stands alone.
SLICE_BYTES = 2 << 20
#: Strings whose values a task remembers, of at most so many characters each.
REMEMBERED, REMEMBERED_CHARS = 120_000, 48
#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all nodes share: ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every node can reach")
            folder = tempfile.mkdtemp(prefix="ratewatch-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """``frame`` from a reliable checkpoint in the shared folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` from a table written in the shared folder, smaller than a checkpoint; columns can be read alone."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes in ``column``, at least one row each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:], strict=False):
        yield batch.slice(start, end - start)


#: Spark's suffixes of byte sizes, as powers of 1024.
_UNITS = {"": 0, "b": 0, "k": 1, "kb": 1, "m": 2, "mb": 2, "g": 3, "gb": 3, "t": 4, "tb": 4, "p": 5, "pb": 5}


def byte_size(text: str) -> int:
    """Bytes of a Spark setting such as ``4194304b``, ``512k`` or ``1m``; without a number, -1."""
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", text.lower())
    return int(found.group(1)) << 10 * _UNITS[found.group(2)] if found and found.group(2) in _UNITS else -1


def small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, whose session sends Arrow batches of at most about ``BATCH_BYTES`` from now on.

    Batches of long texts would otherwise take 64 MB each, held by the JVM and by
    the Python worker. The limit is a session setting, read when a plan runs; a
    lower one stays.
    """
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < byte_size(conf.get(name)) <= BATCH_BYTES:
        conf.set(name, f"{BATCH_BYTES}b")
    return rows


def give_back() -> None:
    """Return memory that is free to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mapped(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``rows`` in small batches through ``run``; at a task's end its worker, which Spark keeps, gives its memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return small_batches(rows).mapInArrow(task, schema)


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which Spark can split a hot key's partition of ``left``.

    It splits only what a shuffle right below the join has dealt, but shuffles no
    side anew that an aggregate has left dealt by the keys. One more key, always
    zero, has both sides shuffled for the join.
    """
    zero = F.pmod(F.xxhash64(keys[0]), F.lit(1))
    return left.withColumn("_zero", zero).join(right.withColumn("_zero", zero), [*keys, "_zero"], how).drop("_zero")


def first_by_hash(
    rows: DataFrame, salt: str, key: Column, count: int, total: int, ties: list[str], times: int = 8
) -> pa.Table:
    """The ``count`` rows that come first by a hash of ``key``, on the driver, with the hash as ``_order``.

    ``total`` is a number of rows that these are among. Tasks send only rows
    below a hash that about ``times`` x ``count`` of ``total`` lie below, so what
    the driver and the last task get does not grow with the number of tasks. Where
    that leaves too few rows, the bound is widened to twice what their share asks for.
    """
    ordered = rows.withColumn("_order", F.xxhash64(F.lit(salt), key))
    share = min(1.0, times * count / max(total, 1))
    while True:
        below = ordered if share == 1.0 else ordered.where(F.col("_order") < int(-(2**63) + share * 2**64))
        found = below.orderBy("_order", *ties).limit(count).toArrow()
        if found.num_rows == count or share == 1.0:
            return found
        share = min(1.0, share * max(2.0, 2 * count / max(found.num_rows, 1)))


def gathered(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that start at ``first`` and have this ``size``, end to end."""
    ends = np.cumsum(size)
    return values[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class Recent:
    """Values of strings, remembered up to a bound; when it is reached, those met since the last time stay.

    It lives as long as a task, so that no worker keeps it for the next stage.
    ``values`` makes the values of strings that are not remembered.
    """

    def __init__(self, values: Callable[[list[str]], list[bytes]]):
        self.values, self.now, self.before = values, {}, {}

    def __call__(self, keys: pa.StringArray) -> list[bytes]:
        """The values of distinct keys."""
        keys = keys.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.now.get, keys))
        if None in found:
            at = [i for i, value in enumerate(found) if value is None]
            again = list(map(self.before.get, [keys[i] for i in at]))
            for i, value in zip(at, again, strict=True):
                found[i] = value
            new = [i for i, value in zip(at, again, strict=True) if value is None]
            for i, value in zip(new, self.values([keys[i] for i in new]), strict=True):
                found[i] = value
            if 2 * (len(self.now) + len(at)) > REMEMBERED:
                self.before, self.now = self.now, {}
            self.now.update((keys[i], found[i]) for i in at if len(keys[i]) <= REMEMBERED_CHARS)
        return found


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One list per array. A list column of an Arrow batch counts its values in 32 bits."""
    ends = np.cumsum([0, *(len(p) for p in parts)])
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def sql_type(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()
