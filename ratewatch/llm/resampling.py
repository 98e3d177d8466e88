"""Operator 13: target-distribution importance resampling with segment deduplication.

Line breaks part words, so a text's features are those of its lines and, for runs
of more than one word, those that cross a break. Texts are cut into lines, equal
lines of the whole table are brought together with their occurrences, and each
distinct line's features are counted once, times its occurrences. Runs that cross
breaks are added from the texts themselves. Features fall into hash buckets; the
two tables' bucket counts, at most one row per bucket, give each bucket's gain.
In the same way a document's weight is the sum over its lines, of which a task
weighs each distinct one once, and over its crossing runs.

The draw ranks all documents by weight plus noise that a hash of the id gives:
rows are sorted by ranges into parts, and a part's first rank is the number of
rows in parts before.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.common import cut, mapped, slices, split_join, sql_type

#: Distinct lines, and features, that a task remembers at a time.
REMEMBERED = 60_000
#: Rows of a distinct-lines batch that are counted together.
LINES = 2048

_KEPT = {*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100), 0x0A}
_SMALL = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: What parts words becomes a space, a line break stays one, A to Z become small.
PLAIN = bytes(b if b in _KEPT else 0x20 for b in _SMALL)


def bucket(feature: bytes, buckets: int) -> int:
    return zlib.crc32(feature) % buckets


def runs(words: list[bytes], most: int) -> Iterator[bytes]:
    """All runs of 1 to ``most`` of these words, joined by a space."""
    yield from words
    for n in range(2, most + 1):
        for i in range(len(words) - n + 1):
            yield b" ".join(words[i : i + n])


def crossing(lines: list[list[bytes]], most: int) -> Iterator[bytes]:
    """The runs of 2 to ``most`` words that lie on more than one of these lines."""
    if most < 2:
        return
    words, ends = [w for line in lines for w in line], np.cumsum([len(line) for line in lines])
    # A run crosses if it starts before a break and ends behind it; one that crosses several counts at the first.
    before = 0
    for end in sorted({int(e) for e in ends if 0 < e < len(words)}):
        for n in range(2, most + 1):
            for i in range(max(before, end - n + 1), min(end, len(words) - n + 1)):
                yield b" ".join(words[i : i + n])
        before = end


class Buckets(dict):
    """The bucket of each feature, remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        at = self[feature] = bucket(feature, self.buckets)
        return at


def bucket_counts(texts: DataFrame, buckets: int, most: int = 1, text_col: str = "text") -> np.ndarray:
    """How often each bucket's features occur in all texts of the table.

    Distinct lines are counted once, times their occurrences. The driver gets
    one row per bucket at most.
    """

    def cut_into_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                seen: Counter = Counter()
                for raw in part.column("_text").cast(pa.binary()).to_pylist():
                    if raw:
                        seen.update(b" ".join(line.split()) for line in raw.translate(PLAIN).split(b"\n"))
                seen.pop(b"", None)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.binary()), pa.array(seen.values(), pa.int64())], ["line", "n"])

    def counted(total: np.ndarray, features: Iterable[bytes], times: int = 1) -> None:
        for feature, n in Counter(features).items():
            total[bucket(feature, buckets)] += n * times

    def rows(total: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, LINES):
                part = batch.slice(start, LINES)
                by_times: dict[int, list[bytes]] = {}
                for line, n in zip(part.column("line").to_pylist(), part.column("n").to_pylist(), strict=True):
                    by_times.setdefault(n, []).append(line)
                for n, lines in by_times.items():
                    counted(total, (f for line in lines for f in runs(line.split(b" "), most)), n)
        yield rows(total)

    def of_crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "_text"):
                for raw in part.column("_text").cast(pa.binary()).to_pylist():
                    counted(total, crossing([line.split() for line in (raw or b"").translate(PLAIN).split(b"\n")], most))
        yield rows(total)

    plain = texts.select(F.col(text_col).alias("_text"))
    lines = mapped(plain, cut_into_lines, "line binary, n bigint").groupBy("line").agg(F.sum("n").alias("n"))
    counts = mapped(lines, of_lines, "bucket int, n bigint")
    if most > 1:
        counts = counts.union(mapped(plain, of_crossings, "bucket int, n bigint"))
    found = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of smoothed target and source shares, in thousandths, rounded down."""
    n = len(source)
    ratio = (target + 1.0) * float(source.sum() + n) / ((source + 1.0) * float(target.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Each bucket's gain, and the most words of a run."""

    gain: np.ndarray
    most: int


def fit(docs: DataFrame, target: DataFrame, buckets: int = 10_000, most: int = 1, text_col: str = "text") -> Model:
    """Gains of ``target``'s texts over those of ``docs``, over all of both tables."""
    return Model(gains(bucket_counts(docs, buckets, most, text_col), bucket_counts(target, buckets, most, text_col)), most)


def weighed(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model.gain)
    most = model.most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value.tolist()
        at = Buckets(len(gain)).__getitem__
        known: dict[bytes, tuple[int, int, int]] = {}
        for batch in batches:
            for part in slices(batch, "_text"):
                found = []
                for raw in part.column("_text").cast(pa.binary()).to_pylist():
                    lines = (raw or b"").translate(PLAIN).split(b"\n")
                    words = features = weight = 0
                    for line, times in Counter(lines).items():
                        if line not in known:
                            split = line.split()
                            own = split if most == 1 else list(runs(split, most))
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[line] = len(split), len(own), sum([gain[b] for b in map(at, own)])
                        w, f, g = known[line]
                        words, features, weight = words + w * times, features + f * times, weight + g * times
                    if most > 1:
                        more = list(crossing([line.split() for line in lines], most))
                        features, weight = features + len(more), weight + sum(gain[at(f)] for f in more)
                    found.append((words, features, weight))
                known.clear()
                columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), *columns], names)

    names = ["_id", "n_words", "n_features", "weight"]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = f"_id {sql_type(docs, id_col)}, n_words bigint, n_features bigint, weight bigint"
    return mapped(rows, run, schema).withColumnRenamed("_id", id_col)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    buckets: int = 10_000,
    most: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    Features are all runs of 1 to ``most`` words, repeats counted; a weight is the
    sum of their buckets' gains. The score adds Gumbel noise from a hash of
    ``seed`` and the id. Of the N rows with ``least_words`` words or more,
    floor(percent * N / 100) with the highest scores are drawn; ``rank`` counts
    them from 1, ties to the smaller id, and is null for all others. Null and
    empty texts have no features and weight 0. A null id counts as an empty one
    in the hash and comes last among ties. Repeated rows are drawn each, in any
    order among themselves. Further columns are not read; empty tables give no
    rows, an empty target equal targets for all buckets.
    """
    rows = weighed(docs, fit(docs, target, buckets, most, text_col), id_col, text_col)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    row = F.monotonically_increasing_id()
    scored = cut(rows.withColumns({"score": F.col("weight") + noise, "_row": row}))
    able = scored.where(F.col("n_words") >= least_words).select(F.col(id_col).alias("_id"), "score", "_row")
    order = [F.desc("score"), F.asc_nulls_last("_id"), F.asc("_row")]
    # Ids of rows hold the part above bit 33 and the place in it below.
    by_range = able.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = cut(by_range.select("_row", F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", 33).cast("int")
    sizes = {r["part"]: r["n"] for r in laid.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    drawn = percent * sum(sizes.values()) // 100
    # One row per range of the sort, at most as many as there are shuffle partitions.
    before = accumulate([0, *(sizes[p] for p in sorted(sizes))])
    starts = docs.sparkSession.createDataFrame(list(zip(sorted(sizes), before, strict=False)), "part int, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    laid = laid.withColumn("part", part).join(F.broadcast(starts), "part")
    ranks = laid.select("_row", rank.alias("rank")).where(F.col("rank") <= drawn)
    return scored.join(ranks, "_row", "left").select(id_col, "n_features", "weight", "score", "rank")
