"""Operator 11: packing into fixed windows by minimum bin slack.

Texts become token ids once, cut at every ``window`` ids, and are written to a
table. The lengths of all pieces form a histogram of at most ``window`` rows,
whatever the corpus holds, and windows are planned on it: the longest length
left is set, a bitset of reachable sums over the other lengths left, longest
first, finds the multiset that fills the window closest to capacity, and the
saved bitsets are walked back to the count of each length. The same window is
then repeated as often as its lengths last, so the plan's size follows the lengths,
not the pieces: 12,654 entries for 250,000 pieces, 1.9 million (15 MB a column) for
12 million millions of pieces evenly spread over 4096 lengths.
Where even the best multiset leaves slack, one more piece is cut to fill it and
its rest goes back among the lengths left. What is left in the end, less than a
window, is laid into windows whose sizes are powers of two, which need no padding.

A piece finds its place by its length and its rank among pieces of that length:
the rank within the task that made it, and the number of those in tasks before.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratewatch.llm.bpe import ID, LETTER, NUMBER, SPACE, merging
from ratewatch.llm.common import BATCH_BYTES, Recent, gathered, mapped, slices, sql_type, stored

#: Characters of a text that are split into words at a time.
BLOCK_CHARS = 1 << 20
#: A pre-token expression that drops all white space, and the same for Latin-1
#: with its classes written out and line ends kept.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+|\n")


def parts_at_spaces(saved: str) -> bool:
    """Whether white space always parts tokens, so that words between it can be encoded alone."""
    config = json.loads(saved)
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    before = (config.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    replace = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    split = {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
    return (
        (config.get("normalizer") is None or bool(steps))
        and all(s in ({"type": "NFC"}, {"type": "Lowercase"}, replace) for s in steps)
        and before[0] == split
        and not config.get("post_processor")
        and not any(t[k] for t in config["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and not any(c.isspace() for t in config["added_tokens"] for c in t["content"])
    )


def blocks(text: str, most: int = BLOCK_CHARS) -> Iterator[str]:
    """``text`` in blocks that end at a space, a line end or the end."""
    start = 0
    while len(text) - start > most:
        end = next((i + 1 for i in range(start + most, len(text)) if text[i] in " \n"), len(text))
        yield text[start:end]
        start = end
    yield text[start:]


class Encoder:
    """Token ids of texts, as the bytes of ``ID`` numbers.

    Of the words between white space, and then of the pre-tokens in them, each
    distinct one of a call is looked at once, and only pre-tokens not met lately
    are merged. Words that hold a special token or a character beyond Latin-1,
    where normalisation does more than make letters small, go to the library whole.
    """

    def __init__(self, saved: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(saved)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_words = parts_at_spaces(saved)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.merged = Recent(merging(self.library.model))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """All texts' ids; a long one is encoded block by block."""
        if not self.by_words:
            return [self._whole(t) for t in texts]
        short = self._together([t if len(t) <= BLOCK_CHARS else "" for t in texts])
        return [
            own if len(t) <= BLOCK_CHARS else b"".join(self._together([block])[0] for block in blocks(t))
            for t, own in zip(texts, short, strict=True)
        ]

    def _together(self, texts: list[str]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = words.flatten().dictionary_encode()
        ids, first, size = self._words(coded.dictionary)
        word = coded.indices.to_numpy()
        ends = np.append(0, np.cumsum(size[word]))
        ids = gathered(ids, first[word], size[word])
        # Where each text's words, and so its ids, end.
        edges = ends[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        return [ids[s:e].tobytes() for s, e in zip(edges, edges[1:], strict=False)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of these words, and where each one's start and how many they are."""
        odd = pc.invert(pc.match_substring_regex(words, r"^[\x00-\x{ff}]*$"))
        for content in self.added:
            odd = pc.or_(odd, pc.match_substring(words, content))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = words.filter(pa.array(~odd))
        # One text of all words, each with a line end behind it, which no word holds.
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(plain)], plain), "\n")[0].as_py() + "\n"
        parts = pa.array(LATIN_WORDS.findall(text.lower()), pa.string()).dictionary_encode()
        known = self.merged(parts.dictionary)
        mark = parts.dictionary.index("\n").as_py()
        known[mark] = b""
        size = np.fromiter(map(len, known), np.int64, len(known)) // ID.itemsize
        part = parts.indices.to_numpy()
        ends = np.cumsum(size[part])
        ids = [gathered(np.frombuffer(b"".join(known), ID), (np.cumsum(size) - size)[part], size[part])]
        sizes = np.zeros(len(words), np.int64)
        sizes[~odd] = np.diff(ends[part == mark], prepend=0)[: len(plain)]
        for at in np.flatnonzero(odd).tolist():
            own = np.frombuffer(self._whole(words[at].as_py()), ID)
            ids.append(own)
            sizes[at] = len(own)
        order = np.r_[np.flatnonzero(~odd), np.flatnonzero(odd)]
        first = np.zeros(len(words), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(ids), first, sizes

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, ID).tobytes()


def best_fill(room: int, lengths: list[int], left: dict[int, int]) -> dict[int, int]:
    """Counts of ``lengths`` (ascending, ``left`` of each) whose sum is the largest up to ``room``."""
    whole, mask = 1 << room, (1 << (room + 1)) - 1
    reach, saved = 1, []
    for i in reversed(range(bisect_right(lengths, room))):
        length = lengths[i]
        copies = min(left[length], room // length)
        saved.append((length, reach))
        step = 1
        while copies > 0:
            step = min(step, copies)
            reach |= (reach << (step * length)) & mask
            copies -= step
            step *= 2
        if reach & whole:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(saved):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            used[length] = times
    return used


@dataclass
class Plan:
    """Where the pieces of each length go, by their rank among these.

    Entry i holds for pieces of ``length`` from rank ``first`` on, up to the next
    entry: piece ``first + j * each + k`` goes to sequence ``sequence + j`` at
    ``offset + k * length``. If ``cut`` is above 0, only that many ids go there,
    and the rest is the piece of rank ``rest + j`` among those of its length.
    """

    window: int
    length: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    rest: list[int] = field(default_factory=list)
    sequences: int = 0

    def add(self, length: int, first: int, each: int, sequence: int, offset: int, cut: int = 0, rest: int = 0) -> None:
        for name, value in zip(ENTRY, (length, first, each, sequence, offset, cut, rest), strict=True):
            getattr(self, name).append(value)

    def arrays(self) -> dict[str, np.ndarray]:
        """The entries as columns in order of length and rank, and ``key``, which both make."""
        columns = {name: np.array(getattr(self, name), np.int64) for name in ENTRY}
        order = np.lexsort((columns["first"], columns["length"]))
        columns = {name: values[order] for name, values in columns.items()}
        return columns | {"key": (columns["length"] << RANK_BITS) + columns["first"]}


ENTRY = ("length", "first", "each", "sequence", "offset", "cut", "rest")
#: Ranks fit in so many bits, lengths in those above.
RANK_BITS = 44


def plan(counts: dict[int, int], window: int) -> Plan:
    """Windows for pieces of these lengths, 1 to ``window`` each, without padding.

    All windows are full, but those of the last ids, fewer than ``window``,
    whose sizes are falling powers of two.
    """
    made = Plan(window)
    left = {length: n for length, n in counts.items() if n > 0}
    next_rank, total = dict.fromkeys(left, 0), dict(left)

    def take(length: int, n: int) -> int:
        first = next_rank[length]
        next_rank[length] += n
        left[length] -= n
        if not left[length]:
            del left[length], lengths[bisect_left(lengths, length)]
        return first

    def give(length: int, n: int) -> int:
        first = total.get(length, 0)
        total[length] = first + n
        next_rank.setdefault(length, 0)
        if length not in left:
            left[length] = 0
            insort(lengths, length)
        left[length] += n
        return first

    lengths = sorted(left)
    ids = sum(length * n for length, n in left.items())
    while ids >= window:
        longest = lengths[-1]
        left[longest] -= 1
        used = best_fill(window - longest, lengths, left)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        slack = window - sum(length * n for length, n in used.items())
        # Every piece left is longer than the slack, else it would have been used.
        extra = next((x for x in lengths if left[x] > used.get(x, 0)), 0) if slack else 0
        needed = dict(used)
        if extra:
            needed[extra] = needed.get(extra, 0) + 1
        times = min(left[length] // n for length, n in needed.items())
        offset = 0
        for length in sorted(used, reverse=True):
            made.add(length, take(length, used[length] * times), used[length], made.sequences, offset)
            offset += length * used[length]
        if extra:
            first = take(extra, times)
            made.add(extra, first, 1, made.sequences, offset, slack, give(extra - slack, times))
        made.sequences += times
        ids -= window * times
    size = offset = 0
    while ids:
        if not size:
            size, offset = 1 << (ids.bit_length() - 1), 0
        length = lengths[-1]
        put = min(length, size - offset)
        first = take(length, 1)
        made.add(length, first, 1, made.sequences, offset, *((put, give(length - put, 1)) if put < length else ()))
        offset += put
        ids -= put
        if offset == size:
            size, made.sequences = 0, made.sequences + 1
    return made


def placed(entries: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, start in the piece, length, sequence and offset of all parts of these pieces, some at a time."""
    row, start = np.arange(len(length)), np.zeros(len(length), np.int64)
    while len(row):
        at = np.searchsorted(entries["key"], (length << RANK_BITS) + rank, "right") - 1
        e = {name: values[at] for name, values in entries.items()}
        turn, within = np.divmod(rank - e["first"], e["each"])
        size = np.where(e["cut"] > 0, e["cut"], length)
        yield row, start, size, e["sequence"] + turn, e["offset"] + within * length
        more = e["cut"] > 0
        row, start, length, rank = row[more], (start + size)[more], (length - size)[more], (e["rest"] + turn)[more]


def stored_type(path: str, end_id: int) -> np.dtype:
    """The narrowest numbers that hold all ids of the tokenizer, for tables and shuffles."""
    tokenizer = Tokenizer.from_file(path)
    largest = max([end_id, *tokenizer.get_vocab(with_added_tokens=True).values()])
    return np.dtype("<u2") if largest < 1 << 16 else ID


def pieces(
    docs: DataFrame, path: str, kind: np.dtype, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The ids of every row, with ``end_id`` behind them, cut at every ``window``: ``_id``, ``start``, ``length``,
    ``doc_tokens``, ``ids`` (numbers of ``kind``), and ``_task`` and ``_rank``, the rank among pieces of that length
    of that task."""
    with open(path, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, encode = TaskContext.get().partitionId(), [0] * (window + 1), Encoder(sent.value)
        for batch in batches:
            for part in slices(batch, "_text", BATCH_BYTES):
                at, start, length, tokens, ids, rank = [], [], [], [], [], []
                texts = part.column("_text").to_pylist()
                for i, raw in enumerate(encode([t or "" for t in texts])):
                    own = np.append(np.frombuffer(raw, ID), end_id).astype(kind)
                    for s in range(0, len(own), window):
                        piece = own[s : s + window]
                        at.append(i)
                        start.append(s)
                        length.append(len(piece))
                        tokens.append(len(own))
                        ids.append(piece.tobytes())
                        rank.append(seen[len(piece)])
                        seen[len(piece)] += 1
                for s in range(0, len(at), 256):
                    e = slice(s, s + 256)
                    columns = [pa.array(c[e], pa.int64()) for c in (start, length, tokens, [task] * len(at), rank)]
                    own = part.column("_id").take(pa.array(at[e], pa.int64()))
                    yield pa.RecordBatch.from_arrays([own, *columns, pa.array(ids[e], pa.binary())], names)

    names = ["_id", "start", "length", "doc_tokens", "_task", "_rank", "ids"]
    numbers = ", ".join(f"{n} bigint" for n in names[1:-1])
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return mapped(rows, run, f"_id {sql_type(docs, id_col)}, {numbers}, ids binary")


def packed(
    docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``.

    A row's ids are those of the ``tokenizers`` file at ``path`` without added
    special tokens, then ``end_id``; ``ids`` holds a piece's as unsigned 32-bit
    numbers, lowest byte first. Pieces of a row lie end to end from ``start`` 0
    to ``doc_tokens``, and pieces of a sequence from ``offset`` 0. All sequences
    hold ``window`` ids, but the last few, which hold falling powers of two.
    A null or empty text is its ``end_id`` alone. Repeated rows and rows with a
    null id are packed each; further columns are not read. No rows give none.

    ``window`` is at most 2^18. The driver holds the histogram of lengths, one
    row per length, and the plan made from it. Ids are written to the shared
    folder and read again, so that lost tasks and the plan see the same pieces.
    """
    if not 1 <= window <= 1 << 18:
        raise ValueError("window must be between 1 and 2^18")
    kind = stored_type(path, end_id)
    kept = stored(pieces(docs, path, kind, window, end_id, id_col, text_col), "pieces")
    per_task = kept.groupBy("_task", "length").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    sent = docs.sparkSession.sparkContext.broadcast(plan(counts, window).arrays())
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = kept.join(offsets, ["_task", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids"):
                yield _laid(part, sent.value, kind, names)

    names = ["_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    numbers = ", ".join(f"{n} bigint" for n in names[1:-1])
    rows = ranked.select("_id", "start", "length", "doc_tokens", (F.col("_rank") + F.col("_before")).alias("_rank"), "ids")
    laid = mapped(rows, run, f"_id {sql_type(docs, id_col)}, {numbers}, ids binary")
    return laid.withColumnRenamed("_id", id_col)


def _laid(part: pa.RecordBatch, entries: dict[str, np.ndarray], kind: np.dtype, names: list[str]) -> pa.RecordBatch:
    start, length, tokens, rank = (part.column(n).to_numpy() for n in ("start", "length", "doc_tokens", "_rank"))
    row, inner, size, sequence, offset = (np.concatenate(c) for c in zip(*placed(entries, length, rank), strict=True))
    own = [np.frombuffer(raw, kind).astype(ID) for raw in part.column("ids").to_pylist()]
    ids = [own[i][s : s + n].tobytes() for i, s, n in zip(row.tolist(), inner.tolist(), size.tolist(), strict=True)]
    numbers = [start[row] + inner, size, tokens[row], sequence, offset]
    taken = part.column("_id").take(pa.array(row))
    return pa.RecordBatch.from_arrays([taken, *(pa.array(c, pa.int64()) for c in numbers), pa.array(ids, pa.binary())], names)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and ``ids`` of every sequence of ``packed``: its pieces, end to end."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b"").cast("binary"), lambda done, piece: F.concat(done, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What ``packed`` gives, with the CRC-32 of a piece's ids in place of them."""
    return pieces.select(
        id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
