"""Operator 9: substring deduplication by sliding sentence spans.

A sentence ends behind a word that ends in a stop, at a line end, or at the text's end.
One of over ``LONG`` words is cut further, behind the words that a hash picks (one in
four), and where none is picked, every ``MOST`` words: so unpunctuated text has shared
boundaries too. A span is a run of consecutive sentences: from each sentence on, the
shortest run of at least ``RUN`` sentences and ``WORDS`` words. Every span is hashed by
its words, hashes are joined over all documents, and sentences that any occurrence but
the first covers are removed.

A first pass counts 64-bit hashes by partial sums. Those that repeat set bits of a map
of fixed size (``SLOTS`` bits, 16 MB, whatever the corpus), which is broadcast, so that
only spans that may repeat are shuffled with their places and compared by 128 bits. The
map only saves work; a bit set by another hash costs a row and changes no result.
Counts and first places are partial aggregates, and joins on hashes can be split by
Spark, so a passage in a third of all documents loads no one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.common import mapped, slices, split_join, sql_type

LONG, MOST, RUN, WORDS = 12, 12, 3, 15
SLOTS = 1 << 27
#: Bits of one row of the map, as Spark's bitmap functions have them.
_ROW = 1 << 15
#: Rows alike that one row of a task is multiplied to.
COPIES = 10_000
#: Bytes of text handled at a time.
_SLICE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


@dataclass
class Sentences:
    """Words and sentences of one or more texts, which are joined by line ends to ``raw``."""

    raw: np.ndarray
    word_start: np.ndarray
    word_end: np.ndarray
    word_hash: np.ndarray
    #: First word and the word behind the last, of every sentence, and its text's number.
    first: np.ndarray
    after: np.ndarray
    text: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def sentences(texts: list[bytes]) -> Sentences:
    """All sentences of these texts, by byte offsets in the joined texts."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    none = np.empty(0, np.int64)
    if not len(raw):
        return Sentences(raw, none, none, none.astype(np.uint64), none, none, none)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return Sentences(raw, none, none, none.astype(np.uint64), none, none, none)

    # A word's hash is a sum over its bytes of random numbers by byte and place, mixed.
    rng = np.random.default_rng(29)
    of_byte = rng.integers(1 << 63, size=256, dtype=np.uint64)
    of_place = rng.integers(1 << 63, size=4096, dtype=np.uint64) | np.uint64(1)
    length = end - start
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    letters = raw[~space]
    hashed = mixed(np.add.reduceat(of_byte[letters] * of_place[place & 4095], np.cumsum(length) - length) + length.astype(np.uint64))

    lines = np.cumsum(raw == 0x0A)
    ends = _STOP[raw[end - 1]]
    ends[:-1] |= lines[start[1:]] > lines[end[:-1] - 1]
    ends[-1] = True
    size, position = _within(ends)
    ends |= (size > LONG) & (hashed & np.uint64(3) == 0)
    size, position = _within(ends)
    ends |= (size > MOST) & (position % MOST == MOST - 1)
    after = np.flatnonzero(ends) + 1
    first = np.r_[0, after[:-1]]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return Sentences(raw, start, end, hashed, first, after, np.searchsorted(begins, start[first], side="right") - 1)


def _within(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each word's sentence, and its place in it."""
    last = np.flatnonzero(ends)
    size = np.diff(np.r_[-1, last])
    return np.repeat(size, size), np.arange(len(ends)) - np.repeat(last + 1 - size, size)


@dataclass
class Spans:
    """The text's number, first sentence and the sentence behind the last (counted in its text), and both hashes."""

    text: np.ndarray
    first: np.ndarray
    after: np.ndarray
    h: np.ndarray
    g: np.ndarray


def spans(texts: list[bytes]) -> Spans:
    s = sentences(texts)
    count = len(s.first)
    # Sentences of a text are numbered from its first one.
    base = np.searchsorted(s.text, s.text)
    stop = np.searchsorted(s.text, s.text, side="right")
    number = np.arange(count)
    after = np.maximum(number + RUN, np.searchsorted(s.after, s.first + WORDS) + 1)
    kept = np.flatnonzero(after <= stop)
    after = after[kept]
    start, end = s.first[kept], s.after[after - 1]
    hashes = []
    for factor in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95):
        # A polynomial over the words, shifted back to the span's own start.
        power = np.cumprod(np.full(len(s.word_hash), factor, np.uint64)) if count else np.empty(0, np.uint64)
        back = np.cumprod(np.full(len(s.word_hash), pow(factor, -1, 1 << 64), np.uint64)) if count else power
        total = np.r_[np.uint64(0), np.cumsum(mixed(s.word_hash ^ np.uint64(factor)) * power, dtype=np.uint64)]
        own = (total[end] - total[start]) * back[start] if len(kept) else np.empty(0, np.uint64)
        hashes.append(mixed(own + (end - start).astype(np.uint64) * np.uint64(factor)).view(np.int64))
    return Spans(s.text[kept], kept - base[kept], after - base[kept], *hashes)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text_hash"), text.cast("binary").alias("_text")
    )


def repeating(docs: DataFrame, text_col: str) -> np.ndarray:
    """The map: one bit for each slot that a span's hash has which occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                found = spans([t or b"" for t in part.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(found.h)], ["h"])

    texts = docs.select(F.col(text_col).cast("binary").alias("_text"))
    hashes = mapped(texts, run, "h bigint")
    often = hashes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    slot = F.col("h").bitwiseAND(SLOTS - 1) + 1
    rows = often.groupBy(F.bitmap_bucket_number(slot).alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    bits = np.zeros((SLOTS // _ROW, _ROW // 8), np.uint8)
    for row in rows.toLocalIterator():  # at most SLOTS / _ROW rows
        bits[row["row"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def candidates(docs: DataFrame, bits: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_text_hash``, ``first``, ``after``, ``h`` and ``g`` of the spans whose slot is set."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                found = spans([t or b"" for t in part.column("_text").to_pylist()])
                slot = found.h & (SLOTS - 1)
                some = np.flatnonzero(sent.value[slot >> 3] >> (slot & 7) & 1)
                row = pa.array(found.text[some])
                columns = [part.column(c).take(row) for c in ("_id", "_text_hash")]
                columns += [pa.array(x[some], pa.int32()) for x in (found.first, found.after)]
                columns += [pa.array(x[some]) for x in (found.h, found.g)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "_text_hash", "first", "after", "h", "g"]
    kind = sql_type(docs, id_col)
    schema = f"_id {kind}, _text_hash bigint, first int, after int, h bigint, g bigint"
    return mapped(_rows(docs, id_col, text_col), run, schema)


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The spans that are not the first of their kind: ``_id``, ``_text_hash``, ``first``, ``after``, and ``source``.

    Occurrences are in order of id (null first), text hash and place; ``source``
    is the id of the first.
    """
    some = candidates(docs, repeating(docs, text_col), id_col, text_col)
    # Rows with the same id and text have one place; ``deduplicated`` numbers them.
    place = F.struct("_id", "_text_hash", "first")
    firsts = some.groupBy("h", "g").agg(F.min(place).alias("place"), F.max(place).alias("last"))
    firsts = firsts.where("place <> last").select("h", "g", "place")
    met = split_join(some, firsts, ["h", "g"]).where(~place.eqNullSafe(F.col("place")))
    return met.select("_id", "_text_hash", "first", "after", F.col("place._id").alias("source"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` without its repeated sentences: ``id_col``, ``text``, ``n_removed``, ``removed``, ``sources``.

    ``n_removed`` counts sentences; ``removed`` holds the code points cut, as
    arrays of start and end; ``sources`` the ids of the documents with the first
    occurrences, in order. The first occurrence stays whole; within one
    document, too, the first stays. Removing takes the sentence and the white
    space behind it. Of rows that share id and text, null ids among them, one
    counts as the first and the others repeat every span of it; rows that share
    only the id are separate. A null text stays null; a text of fewer than
    ``RUN`` sentences or ``WORDS`` words has no span and stays whole. White space
    is ASCII's. Further columns are not read.
    """
    kind, rows = sql_type(docs, id_col), _rows(docs, id_col, text_col)
    key = ["_id", "_text_hash"]
    copied = rows.where("_text IS NOT NULL").groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")
    found = repeated(docs, id_col, text_col).select(*key, F.struct("first", "after").alias("span"), "source")
    cover = found.unionByName(copied, allowMissingColumns=True).groupBy(*key).agg(
        F.collect_set("span").alias("covered"), F.sort_array(F.collect_set("source")).alias("sources"), F.max("copies").alias("copies")
    )  # at most one entry for each sentence of the document
    own = [F.col(k).alias(f"c{k}") for k in key]
    same = [F.col(k).eqNullSafe(F.col(f"c{k}")) for k in key]
    joined = rows.join(cover.select(*own, "covered", "sources", "copies"), same, "left")
    single = joined.where("copies IS NULL").select("_id", "_text", "covered", "sources", F.lit(1).cast("bigint").alias("copies"))
    # Rows that are alike in all that is read: one of each is enough, with their number.
    alike = rows.join(copied.select(*own), same, "left_semi").groupBy(*key).agg(F.first("_text").alias("_text"))
    alike = alike.join(cover.select(*own, "covered", "sources", "copies"), same).select("_id", "_text", "covered", "sources", "copies")

    def run(batches: Iterator[pa.RecordBatch], repeats: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                ids, texts, covered = (part.column(c).to_pylist() for c in ("_id", "_text", "covered"))
                sources = [own or [] for own in part.column("sources").to_pylist()]
                covered = [{(c["first"], c["after"]) for c in own or []} for own in covered]
                if repeats:
                    every = [set(zip(x.first.tolist(), x.after.tolist(), strict=True)) for x in (spans([t]) for t in texts)]
                    # What no other document holds first, the first of these rows does.
                    sources = [
                        sorted({*s, i}) if i is not None and e - c else s
                        for i, e, c, s in zip(ids, every, covered, sources, strict=True)
                    ]
                    covered = every
                cleaned = [without(t, list(c)) if c else (t, 0, []) for t, c in zip(texts, covered, strict=True)]
                flat = [place for c in cleaned for place in c[2]]
                places = pa.StructArray.from_arrays([pa.array([p[i] for p in flat], pa.int64()) for i in (0, 1)], ["start", "end"])
                ends = np.cumsum([0, *(len(c[2]) for c in cleaned)])
                columns = [
                    part.column("_id"), pa.array([c[0] for c in cleaned], pa.binary()), pa.array([c[1] for c in cleaned], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places), pa.array(sources, part.column("sources").type),
                    part.column("copies"),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "_text", "n_removed", "removed", "sources", "copies"]
    schema = f"_id {kind}, _text binary, n_removed bigint, removed array<struct<start:bigint,end:bigint>>, sources array<{kind}>, copies bigint"
    first = mapped(single.unionByName(alike), lambda batches: run(batches, False), schema)
    others = mapped(alike, lambda batches: run(batches, True), schema)
    # As many rows as there were, a bounded number from each task's row.
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 2) / COPIES)))
    dealt = others.withColumn("chunk", chunk).repartition("_id", "chunk")
    left = F.least(F.lit(COPIES), F.col("copies") - 1 - F.col("chunk") * COPIES)
    others = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left.cast("bigint"))))
    return first.unionByName(others.select(*names)).select(
        F.col("_id").alias(id_col), F.col("_text").cast("string").alias("text"), "n_removed", "removed", "sources"
    )


def without(text: bytes, covered: list[tuple[int, int]]) -> tuple[bytes, int, list[tuple[int, int]]]:
    """The text without the covered sentences, their number, and the places cut, in code points."""
    found = sentences([text])
    gone = np.zeros(len(found.first) + 1, dtype=np.int64)
    for first, after in covered:
        gone[first] += 1
        gone[after] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    begin = found.word_start[found.first]
    until = np.append(begin[1:], len(text))
    kept = np.ones(len(text), dtype=bool)
    for i in np.flatnonzero(gone).tolist():
        kept[begin[i] : until[i]] = False
    raw = np.frombuffer(text, np.uint8)
    point = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    edges = np.flatnonzero(np.diff(np.r_[True, kept, True].astype(np.int8)))
    places = [(int(point[a]), int(point[b])) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return raw[kept].tobytes(), int(gone.sum()), places
