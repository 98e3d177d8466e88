"""Operator 10: document quality by random-indexing vectors and a two-layer network.

Random indexing: every word (by hash, one of ``BUCKETS``) has a sparse ternary index
vector, and its context vector is the sum of the index vectors of the words beside
it, over all documents. The sums are whole numbers, so their order doesn't matter.
A document is pooled to the mean of its words' context vectors, each of length one,
and the mean product of the vectors of words side by side, which shows repetition.
A network of two layers, fitted in numpy on the driver from a bounded sample of labelled
documents, turns it into a logit, and a temperature fitted on a part of the sample
that the network did not see into a calibrated probability.

What reaches the driver is the table of context vectors (``BUCKETS`` x ``DIMS``) and
the sample of ``SAMPLE`` vectors, at most twice as many where ids repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ratewatch.llm.common import lists, mapped, slices

BUCKETS, DIMS, NONZERO = 1 << 14, 32, 4
POOLED = 2 * DIMS
SAMPLE, HIDDEN = 10_000, 16

#: Bytes are white space (0), letters and digits (1; all beyond ASCII) or other marks (2).
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*b"0123456789", *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def index_vectors(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of every bucket's nonzero components."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), np.where(rng.random((BUCKETS, NONZERO)) < 0.5, -1.0, 1.0)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word of these texts, and the word at which each text starts.

    A word is a run of letters and digits, or of other marks. Its bucket is a sum
    of random numbers by byte and place, so all runs are hashed at once.
    """
    rng = np.random.default_rng(3)
    of_byte, of_place = rng.integers(1 << 62, size=256, dtype=np.uint64), rng.integers(1 << 62, size=64, dtype=np.uint64) | 1
    text = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if not len(text):
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    kind = _KIND[text]
    start = np.append(0, np.flatnonzero(kind[1:] != kind[:-1]) + 1)
    place = np.arange(len(text)) - np.repeat(start, np.diff(np.append(start, len(text))))
    hashed = np.add.reduceat(of_byte[text] * of_place[place & 63], start)
    is_word = kind[start] > 0
    bucket = (hashed[is_word] >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.empty(0, np.int64)
    return bucket, np.searchsorted(start[is_word], begins)


def context_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit context vectors of all buckets, gathered from all documents."""
    names = [f"c{d}" for d in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIMS)

        def add(word: np.ndarray, beside: np.ndarray) -> None:
            for k in range(NONZERO):
                at = word * DIMS + places[beside, k]
                np.add(total, np.bincount(at, signs[beside, k], BUCKETS * DIMS), out=total)

        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                word, begin = words([raw or b"" for raw in part.column("_text").to_pylist()])
                beside = np.ones(max(len(word) - 1, 0), bool)
                beside[begin[(begin > 0) & (begin < len(word))] - 1] = False
                at = np.flatnonzero(beside)
                add(word[at], word[at + 1])
                add(word[at + 1], word[at])
        total = total.reshape(BUCKETS, DIMS)
        met = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(met, pa.int32()), *[pa.array(total[met, d].astype(np.int64)) for d in range(DIMS)]]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *names])

    texts = docs.select(F.col(text_col).cast("binary").alias("_text"))
    parts = mapped(texts, run, "bucket int, " + ", ".join(f"{n} bigint" for n in names))
    found = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    vectors = np.zeros((BUCKETS, DIMS), np.float32)
    if found.num_rows:
        rows = np.stack([found[n].to_numpy() for n in names], axis=1).astype(float)
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        vectors[found["bucket"].to_numpy()] = rows / np.maximum(norm, 1e-9)
    return vectors


def pool(word: np.ndarray, begin: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A row for each text: the mean vector, and the mean product of neighbours. Zeros without words."""
    out = np.zeros((len(begin), POOLED))
    count = np.diff(np.append(begin, len(word)))
    full = np.flatnonzero(count)
    if len(full):
        own = vectors[word]
        out[full, :DIMS] = np.add.reduceat(own, begin[full]) / count[full, None]
        beside = own
        beside[:-1] *= own[1:]
        beside[(begin + count)[full] - 1] = 0
        out[full, DIMS:] = np.add.reduceat(beside, begin[full]) / np.maximum(count[full, None] - 1, 1)
    return out.astype(np.float32)


@dataclass
class Network:
    """Standardisation, two layers and a temperature."""

    middle: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    heat: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.middle) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.heat, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 250, rate: float = 0.03, decay: float = 1e-3, seed: int = 5) -> Network:
    """A network by full-batch Adam on four fifths of the rows, its temperature by the rest.

    With labels of fewer than two kinds there is nothing to tell apart: every
    score is the share of ones, counted with one more row of each kind.
    """
    x = np.asarray(x, float).reshape(-1, POOLED)
    middle, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(POOLED), np.ones(POOLED))
    rng = np.random.default_rng(seed)
    net = Network(middle, scale, rng.normal(0, POOLED**-0.5, (POOLED, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        net.b2 = float(np.log(share / (1 - share)))
        return net
    apart = rng.random(len(x)) < 0.2
    if len(np.unique(y[~apart])) < 2:
        apart[:] = False
    z, t = (x[~apart] - middle) / scale, y[~apart]
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        hidden = np.tanh(z @ weights[0] + weights[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -50, 50))) - t) / len(t)
        back = error[:, None] * weights[2] * (1 - hidden**2)
        slopes = [z.T @ back + decay * weights[0], back.sum(0), hidden.T @ error + decay * weights[2], error.sum(keepdims=True)]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = *weights[:3], float(weights[3][0])
    if apart.any():
        logits, truth = net.logits(x[apart]), y[apart]
        heats = np.geomspace(0.2, 5, 81)
        loss = [np.mean(np.logaddexp(0, logits / h) - truth * logits / h) for h in heats]
        net.heat = float(heats[int(np.argmin(loss))])
    return net


def held_out(id_col: str = "doc_id"):
    """True for the rows whose labels are never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    """The word vectors and the network on top of them."""

    vectors: np.ndarray
    net: Network


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Model:
    """Word vectors from all documents, and a network fitted on a sample.

    The sample is the documents of the ``SAMPLE`` labels 0 or 1, outside the
    held-out part, that come first by a hash of their id.
    """
    vectors = context_vectors(docs, text_col)
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    order = F.xxhash64(F.lit("quality"), F.col(id_col))
    known = known.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"), order.alias("_order"))
    known = known.orderBy("_order", "_id", "_label").limit(SAMPLE)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 1 << 20):
                pooled = pool(*words([raw or b"" for raw in part.column("_text").to_pylist()]), sent.value)
                columns = [part.column("_order"), part.column("_label"), lists(list(pooled), pa.float32())]
                yield pa.RecordBatch.from_arrays(columns, ["_order", "_label", "vector"])

    # At most SAMPLE labels are broadcast; a document may be there more than once.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")).join(F.broadcast(known), "_id")
    sample = mapped(rows.drop("_id"), run, "_order bigint, _label double, vector array<float>")
    sample = sample.orderBy("_order", "_label", "vector").limit(2 * SAMPLE).toArrow()
    x = sample["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, POOLED)
    return Model(vectors, fit(x, sample["_label"].to_numpy().astype(float)))


def scored(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``columns`` of every document and ``score_col``, 0 to 1, higher where label 1 is likelier.

    Only the text is an input of the score. Empty and null texts have the zero
    vector and are scored like any other. Rows are kept as they come, repeated
    or with a null id.
    """
    sent, net = docs.sparkSession.sparkContext.broadcast(model.vectors), model.net

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                raw = part.column(text_col).cast(pa.binary()).to_pylist()
                pooled = pool(*words([r or b"" for r in raw]), sent.value)
                scores = pa.array(net.scores(pooled.astype(float)))
                yield pa.RecordBatch.from_arrays([*map(part.column, columns), scores], [*columns, score_col])

    rows = docs.select(*dict.fromkeys([*columns, text_col]))
    schema = StructType([*(docs.schema[c] for c in columns), StructField(score_col, DoubleType())])
    return mapped(rows, run, schema)


def qualities(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` (1 from a score of 0.5 on) of every document.

    ``labels`` has ``id_col`` and ``label_col``; labels other than 0 and 1, and
    those of the held-out part, are not learnt from. A document with several
    labels counts with each.
    """
    found = scored(docs, train(docs, labels, id_col, text_col, label_col), [id_col], text_col)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select(id_col, held_out(id_col).alias("held_out"), "score", predicted)
