"""Operator 12: how filters interact, by folds over all their orders.

Every document gets one bit per filter that it fails. Documents of one part that
fail the same filters are one mask cell: a count, with the good and the toxic
among them. So at most 32 cells a part are left, whatever the corpus holds. Each
cell is folded across the array of all orders: ``transform`` takes the orders, and
``aggregate`` walks an order's filters, carrying whether the cell is still there
and which step took it. That makes 600 structs weighted by the cell's counts, which
are summed element by element within the part.

The filters' bits come from one pass over the texts. Copies are found by
SHA-256: the smallest id of each text that several ids hold is joined back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.common import cut, mapped, slices, split_join, sql_type

#: The filters' letters, in the order of their bits, and their bounds.
FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(raw: bytes) -> int:
    """The bits of filters A to D for a text's UTF-8 bytes. ``split`` parts at U+0020 and U+0009 to U+000D."""
    words = raw.split()
    n = len(words)
    points = int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (
        (n < LEAST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
        | (100 * capitals > CAPITAL_PERCENT * points) << 2
        | (len(raw.translate(None, SIGNS)) < len(raw)) << 3
    )


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``_id``, ``part`` and ``mask`` of every row: bit i is set if it fails filter i.

    A null text is an empty one, a null part an empty string. The last bit, of
    copies, is set if a smaller id has the same text; a null id is neither
    smaller nor larger, and rows of the same id and text are no copies of each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "_text"):
                raw = [t or b"" for t in rows.column("_text").cast(pa.binary()).to_pylist()]
                bits = pa.array([failures(t) for t in raw], pa.int32())
                digest = pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("_id"), rows.column("part"), bits, digest], names)

    names = ["_id", "part", "_bits", "_digest"]
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), part.alias("part"))
    schema = f"_id {sql_type(docs, id_col)}, part string, _bits int, _digest binary"
    judged = cut(mapped(rows, run, schema))
    shared = judged.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    shared = shared.where("_first < _last").select("_digest", "_first")
    joined = split_join(judged, shared, ["_digest"], "left")
    copy = F.coalesce(F.col("_id") > F.col("_first"), F.lit(False))
    return joined.select("_id", "part", F.col("_bits").bitwiseOR(F.when(copy, 16).otherwise(0)).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part``, ``mask``, ``n``, ``good`` and ``toxic``: documents of a part that fail the same filters.

    A document is good (toxic) if any label of its id says quality (toxic) 1.
    """
    flags = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"_{c}") for c in ("quality", "toxic")]
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(*flags)
    # Ids without a label, a null id among them, have zeros.
    joined = split_join(masked, known, ["_id"], "left")
    sums = [F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("_quality", "good"), ("_toxic", "toxic")))]
    return joined.groupBy("part", "mask").agg(*sums)


def folded(orders: Column, mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """A cell's counts at each step of each order, order by order: an array of structs.

    ``orders`` is an array of arrays of filter numbers.
    """
    zero = F.lit(0).cast("long")

    def step(state: Column, which: Column) -> Column:
        here, failed = state["here"], F.getbit(mask, which) == 1
        taken = here & failed
        counts = F.struct(
            which.alias("filter"),
            F.when(here & ~failed, n).otherwise(zero).alias("kept"),
            F.when(taken, n).otherwise(zero).alias("removed"),
            F.when(failed & ~here, n).otherwise(zero).alias("redundant"),
            F.when(failed & (F.bit_count(mask) == 1), n).otherwise(zero).alias("unique_fails"),
            F.when(taken, good).otherwise(zero).alias("good_lost"),
            F.when(taken, toxic).otherwise(zero).alias("toxic_lost"),
        )
        return F.struct((here & ~failed).alias("here"), F.array_append(state["steps"], counts).alias("steps"))

    fields = ", ".join(f"{c}: bigint" for c in COUNTS)
    start = F.struct(F.lit(True).alias("here"), F.array().cast(f"array<struct<filter: int, {fields}>>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def summed(left: Column, right: Column) -> Column:
    """Two cells' arrays, added element by element."""
    add = [(lambda a, b, c=c: (a[c] + b[c]).alias(c)) for c in COUNTS]
    return F.zip_with(left, right, lambda a, b: F.struct(a["filter"].alias("filter"), *(f(a, b) for f in add)))


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step``, with the counts of that step.

    All orders of the five filters, applied left to right: ``kept`` after the step
    and ``removed`` by it; ``redundant`` fail its filter but went before;
    ``unique_fails`` fail its filter only; ``good_lost`` and ``toxic_lost`` are
    the labelled among the removed; ``shapley`` is what its filter removes, summed over
    all orders. Null texts are empty, null parts the empty string, zeros are
    returned as rows. Repeated rows count each. Further columns are not read.
    An empty table has no parts and gives no rows.
    """
    n = len(FILTERS)
    by_order = ["".join(p) for p in permutations(FILTERS)]
    orders = F.array(*(F.array(*(F.lit(FILTERS.index(c)) for c in order)) for order in by_order))
    cell = cells(masks(docs, id_col, text_col, part_col), labels, id_col)
    each = cell.select("part", folded(orders, F.col("mask"), F.col("n"), F.col("good"), F.col("toxic")).alias("steps"))
    # A part has at most 32 cells.
    parts = each.groupBy("part").agg(F.collect_list("steps").alias("_cells"))
    total = F.aggregate(F.slice("_cells", 2, 2**n), F.col("_cells")[0], summed)
    parts = parts.select("part", total.alias("_steps"))

    def removed_by(which: Column) -> Column:
        return F.aggregate("_steps", F.lit(0).cast("long"), lambda done, s: done + F.when(s["filter"] == which, s["removed"]).otherwise(0))

    parts = parts.withColumn("_shapley", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), removed_by))
    rows = parts.select("part", "_shapley", F.posexplode("_steps").alias("_at", "_step"))
    name = F.array(*map(F.lit, by_order))[F.floor(F.col("_at") / n).cast("int")]
    return rows.select(
        "part",
        name.alias("filter_order"),
        (F.col("_at") % n + 1).cast("int").alias("step"),
        *(F.col(f"_step.{c}").alias(c) for c in COUNTS),
        F.col("_shapley")[F.col("_step.filter")].alias("shapley"),
    )
