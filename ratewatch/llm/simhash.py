"""Operator 7: SimHash near-duplicates by a byte-position inverted index.

Two 64-bit fingerprints that differ in at most ``d`` bits agree in at least
``8 - d`` of their eight bytes. The posting lists of the index hold fingerprints
under the values of some byte positions together: the sets of positions are chosen
so that any ``8 - d`` agreeing positions include one of them, so no pair escapes,
and a list over three bytes stays 65,536 times shorter than one over a single byte.
Within a list, the agreeing bytes of each pair are tallied, pairs below the
guaranteed count are dropped, and the rest are verified by their differing bits.
A list gives at most one edge per member, enough to connect what is linked in it;
a long list is dealt out as pairs of blocks. Equal fingerprints are one node.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.llm.common import cut, mapped, slices, split_join, sql_type
from ratewatch.llm.components import roots

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CHUNK = 1 << 15


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """The SimHash of a text's UTF-8 bytes as an unsigned number; 0 without words."""
    letters = np.frombuffer(raw.lower(), np.uint8)
    space = _SPACE[letters]
    keep = ~space
    keep[1:] |= ~space[:-1]
    if letters.size:
        keep[0] = not space[0]
    words = np.where(space[keep], 0x20, letters[keep]).astype(np.uint8)
    if words.size and words[-1] == 0x20:
        words = words[:-1]
    if not words.size:
        return 0
    text, gaps = words.tobytes(), np.flatnonzero(words == 0x20)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, words.size)
    if len(starts) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        bounds = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(text[s:e], 42) for s, e in bounds], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", more: Sequence[Column] = ()
) -> DataFrame:
    """``_id``, ``fp`` (the fingerprint as a signed long) and ``more`` long columns of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                found = [fingerprint(raw or b"", shingle) for raw in part.column("_text").to_pylist()]
                fps = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("_id"), fps, *map(part.column, added)], ["_id", "fp", *added])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"), *more)
    added = rows.columns[2:]
    return mapped(rows, run, f"_id {sql_type(docs, id_col)}, fp bigint" + "".join(f", {c} bigint" for c in added))


def position_sets(matches: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``matches`` positions include one.

    Three positions a set where so many must match, fewer otherwise. Chosen
    greedily until every choice of ``matches`` positions is covered.
    """
    size = max(1, min(3, matches - 1))
    open_sets = set(combinations(range(8), matches))
    chosen = []
    while open_sets:
        best = max(combinations(range(8), size), key=lambda s: sum(set(s) <= set(o) for o in open_sets))
        chosen.append(best)
        open_sets = {o for o in open_sets if not set(best) <= set(o)}
    return chosen


def edges(fps: DataFrame, bits: int = 4, block: int = 1024) -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints within ``bits`` differing bits.

    ``fps`` has one row per fingerprint in ``fp``. ``bits`` may be 0 to 7.
    Lists of over ``block`` members are cut into blocks, and each pair of blocks
    is compared in its own group of at most twice as many rows.
    """
    if not 0 <= bits <= 7:
        raise ValueError("an index over eight bytes guarantees a shared one for at most 7 differing bits")
    sets = position_sets(8 - bits)

    def key(number: int, positions: tuple[int, ...]):
        value = F.lit(number).cast("long")
        for p in positions:
            value = value * 256 + F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)
        return value

    posted = fps.select("fp", F.explode(F.array(*[key(n, s) for n, s in enumerate(sets)])).alias("key"))
    long_lists = (
        posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    dealt = split_join(posted, long_lists, ["key"], "left").select(
        "key", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks"),
    ).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = dealt.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")
    ordered = grouped.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None and held.num_rows else rows
            group = _groups(rows)
            last = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if last:
                yield from _linked(rows["fp"].to_numpy()[:last], group[:last], bits)
            held = rows.slice(last)
        if held is not None and held.num_rows:
            yield from _linked(held["fp"].to_numpy(), _groups(held), bits)

    return ordered.mapInArrow(run, "a bigint, b bigint")


def _groups(rows: pa.Table) -> np.ndarray:
    columns = [rows[c].to_numpy() for c in ("key", "x", "y")]
    new = np.zeros(rows.num_rows, dtype=np.int64)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def within(x: np.ndarray, bits: int) -> np.ndarray:
    """Which of these differences have enough equal bytes, and then at most ``bits`` differing bits."""
    shared = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    keep = np.flatnonzero(shared >= 8 - bits)
    return keep[np.bitwise_count(x[keep]) <= bits]


def _linked(fp: np.ndarray, group: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links within each run of equal ``group``."""
    fp = fp.view(np.uint64)
    end = np.searchsorted(group, group, side="right")
    start = np.searchsorted(group, group)
    small = np.flatnonzero(end - start <= 64)
    left, right = [], []
    for shift in range(1, 64):
        small = small[end[small] > small + shift]
        if not len(small):
            break
        near = small[within(fp[small] ^ fp[small + shift], bits)]
        left.append(near)
        right.append(near + shift)
    label = np.arange(len(fp))
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        while len(a):
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
            if np.array_equal(before, label):
                break
    for s in np.unique(start[end - start > 64]):
        e = end[s]
        own = np.arange(s, e)
        for i in range(s, e - 1):
            near = within(fp[i + 1 : e] ^ fp[i], bits)
            if len(near):
                met = np.unique(np.append(own[near + i + 1 - s], own[i - s]))
                if len(met) > 1:
                    own[np.isin(own, met)] = met[0]
        label[s:e] = own
    joined = np.flatnonzero(label != np.arange(len(fp)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(fp[joined].view(np.int64)), pa.array(fp[label[joined]].view(np.int64))], ["a", "b"]
    )


def components(hashed: DataFrame, bits: int) -> DataFrame:
    """``fp``, ``root`` (the smallest fingerprint that links reach) and ``component_id`` of every fingerprint."""
    classes = hashed.groupBy("fp").agg(F.min("_id").alias("_least"))
    found = roots(edges(classes.select("fp"), bits))
    joined = classes.join(found, classes["fp"] == found["node"], "left").drop("node")
    # Only linked fingerprints are gathered by component.
    linked = joined.where("root IS NOT NULL").groupBy("root").agg(F.min("_least").alias("_component"))
    named = joined.join(linked, "root", "left")
    return named.select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("_component", "_least").alias("component_id"))


def near_duplicates(
    docs: DataFrame, bits: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    The component is the smallest id that links reach, the own one included.
    A null text or one without words has fingerprint zero and is linked like any
    other; fewer words than a shingle's are one shingle. Rows with the same id
    each count. A null id joins components but is never their smallest; if all
    ids of a component are null, so is ``component_id``. Further columns are not
    read. The fingerprints are checkpointed, so texts are hashed once.
    """
    hashed = cut(fingerprints(docs, shingle, id_col, text_col))
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return hashed.join(components(hashed, bits), "fp").select(F.col("_id").alias(id_col), shown, "component_id")


def representatives(
    docs: DataFrame, bits: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the row with the smallest id.

    A null id comes last. Rows with equal ids are told apart by two hashes of
    id and text; of equal rows, one stays.
    """
    keys = [F.xxhash64(F.lit(n), F.col(id_col), F.col(text_col)).alias(f"_key{n}") for n in (1, 2)]
    hashed = cut(fingerprints(docs, shingle, id_col, text_col, keys))
    order = F.struct(F.col("_id").isNull(), "_id", "_key1", "_key2")
    least = hashed.groupBy("fp").agg(F.min(order).alias("least"))
    chosen = components(hashed, bits).join(least, "fp").groupBy("root").agg(F.min("least").alias("least"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), *keys)
    met = rows.join(chosen.select("least._key1", "least._key2"), ["_key1", "_key2"])
    same = Window.partitionBy("_key1", "_key2").orderBy(F.lit(0))
    return met.withColumn("_n", F.row_number().over(same)).where("_n = 1").select("_row.*")
