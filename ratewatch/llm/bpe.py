"""Operator 5: byte-level BPE encoding and decoding.

The ranks of a vocabulary become a ``tokenizers`` model over byte characters. Each
token's merge is found by merging its own bytes with the lower ranks down to two
parts. That gives the ids of rank-based encoders: the bytes of a token never
merge across its ends before it is made, so inside they merge as they do alone.
A token that never comes down to two parts is reached only as a whole
pre-token, which ``ignore_merges`` looks up first.

Texts are split into pre-tokens by ``regex``, whose Unicode tables are current;
each distinct pre-token of some texts is looked at once, and the library's model
merges those that a task has not met lately.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from ratewatch.llm.common import Recent, gathered, lists, mapped, slices, sql_type


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it prints in Latin-1, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return [chr(b) if b in set(prints) else chr(0x100 + others.index(b)) for b in range(256)]


def as_characters(raw: bytes, characters: str) -> str:
    return raw.decode("latin-1").translate(characters)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that make ``token``, or None if lower ranks don't bring it down to two."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        joined = [ranks.get(a + b, own) for a, b in zip(parts, parts[1:], strict=False)]
        best = min(joined)
        if best >= own:
            return None
        at = joined.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def tokenizer_of(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    shown = dict(enumerate(byte_characters()))
    name = {token: as_characters(token, shown) for token in ranks}
    ordered = sorted(ranks, key=ranks.__getitem__)
    made = [merge_of(token, ranks) for token in ordered if len(token) > 1]
    merges = [(name[a], name[b]) for a, b in (pair for pair in made if pair)]
    tokenizer = Tokenizer(models.BPE({name[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


def unsettled_characters() -> str:
    """A class of the characters that two Unicode tables may class differently.

    Compared over the basic plane; every character beyond it counts as unsettled.
    """
    basic = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    differ: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        own = pre_tokenizers.Split(Regex(kind), "removed", invert=True)
        differ |= set("".join(piece for piece, _ in own.pre_tokenize_str(basic))) ^ set(regex.findall(kind, basic))
    return "[" + "".join(regex.escape(c) for c in sorted(differ)) + "\U00010000-\U0010ffff]"


#: The usual pre-token pattern, and the same for Latin-1 texts with its classes written out.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, SPACE = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

#: Bytes of text whose pre-tokens a task holds at a time.
SPLIT_BYTES = 1 << 20
#: Ids that are decoded at a time.
DECODED = 1 << 18
#: Ids are unsigned 32-bit numbers, the lowest byte first.
ID = np.dtype("<u4")


def merging(model: models.Model) -> Callable[[list[str]], list[bytes]]:
    """The ids that ``model`` merges pre-tokens to, as the bytes of ``ID`` numbers."""
    shown, tokenize = dict(enumerate(byte_characters())), model.tokenize

    def merged(words: list[str]) -> list[bytes]:
        ids, ends = [], [0]
        for word in words:
            # Printing ASCII but the space stands for itself.
            plain = word.isascii() and word.isprintable() and " " not in word
            ids += [t.id for t in tokenize(word if plain else as_characters(word.encode(), shown))]
            ends.append(len(ids))
        raw, width = np.array(ids, ID).tobytes(), ID.itemsize
        return [raw[width * s : width * e] for s, e in zip(ends, ends[1:], strict=False)]

    return merged


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All pre-tokens of a text. Latin-1 texts are split by the plainer expression, which classes them alike."""
    split = regex.compile(pattern)
    if pattern != PATTERN:
        return lambda text: [m.group() for m in split.finditer(text)]
    latin = re.compile(LATIN)

    def pre_tokens(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return split.findall(text)
        return latin.findall(text)

    return pre_tokens


@dataclass
class Vocabulary:
    """What tasks need of a file of ranks: the merging model, and the bytes of all tokens in order of their ids.

    Its fields are broadcast as a dict: a broadcast holds no class of a library that executors may not have.
    """

    model: str
    pattern: str
    tokens: bytes
    #: Bytes of each token, -1 for an id that has none.
    size: np.ndarray

    @classmethod
    def read(cls, path: str, pattern: str | None = None) -> Vocabulary:
        """Without a pattern it only decodes."""
        ranks = read_ranks(path)
        size = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        size[list(ranks.values())] = list(map(len, ranks))
        model = "" if pattern is None else tokenizer_of(ranks, pattern).to_str()
        return cls(model, pattern or "", b"".join(sorted(ranks, key=ranks.__getitem__)), size)


class Encoder:
    """Texts to ids, as long as a task lives."""

    def __init__(self, vocabulary: Vocabulary):
        self.merged = Recent(merging(Tokenizer.from_str(vocabulary.model).model))
        self.pre_tokens, self.size = splitter(vocabulary.pattern), vocabulary.size

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these texts, end to end, and where each text's start; the last start is the end."""
        split = [self.pre_tokens(text) for text in texts]
        parts = pa.array(chain.from_iterable(split), pa.string()).dictionary_encode()
        known = self.merged(parts.dictionary)
        size = np.fromiter(map(len, known), np.int64, len(known)) // ID.itemsize
        part = parts.indices.to_numpy()
        ends = np.append(0, np.cumsum(size[part]))
        ids = gathered(np.frombuffer(b"".join(known), ID), (np.cumsum(size) - size)[part], size[part])
        return ids, ends[np.cumsum([0, *map(len, split)])]

    def offsets(self, texts: list[str], ids: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [characters(t, self.size[ids[s:e]]) for t, s, e in zip(texts, starts, starts[1:], strict=False)]


class Decoder:
    """Ids to bytes, by the table of all tokens' bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens, self.size = np.frombuffer(vocabulary.tokens, np.uint8), vocabulary.size
        self.first = np.cumsum(np.maximum(self.size, 0)) - np.maximum(self.size, 0)

    def __call__(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The bytes of lists of ids, which lie end to end; the last start is the end."""
        known = (ids >= 0) & (ids < len(self.size))
        known[known] = self.size[ids[known]] >= 0
        if not known.all():
            raise ValueError(f"ids {ids[~known][:3].tolist()} are not in the vocabulary")
        size = self.size[ids]
        raw = b"".join(
            gathered(self.tokens, self.first[ids[at : at + DECODED]], size[at : at + DECODED]).tobytes()
            for at in range(0, len(ids), DECODED)
        )
        ends = np.append(0, np.cumsum(size))[starts].tolist()
        return [raw[s:e] for s, e in zip(ends, ends[1:], strict=False)]


class Decimals:
    """The text of ids, joined by a space."""

    def __init__(self, count: int):
        shown = [b"%d " % i for i in range(count)]
        self.text, self.size = np.frombuffer(b"".join(shown), np.uint8), np.array(list(map(len, shown)), np.int64)
        self.first = np.cumsum(self.size) - self.size

    def __call__(self, ids: np.ndarray) -> bytes:
        return gathered(self.text, self.first[ids], self.size[ids])[:-1].tobytes()


def encode(
    frame: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False
) -> DataFrame:
    """``id_col``, ``ids`` and, with ``offsets``, ``starts`` and ``ends`` of every row.

    ``path`` names a file of base64 tokens and ranks, ``pattern`` the expression
    that splits texts into pre-tokens. No string is special. Offsets are code
    points, the end exclusive; a token that holds part of a character counts as
    holding all of it. A null text is an empty one and gives an empty list. Rows
    are kept as they come, repeated or with a null id; further columns are not
    read. The file is read on the driver and sent as a broadcast (about 3 MB for
    50,000 tokens); a task keeps the ids of pre-tokens that it has merged lately.
    """
    sent = frame.sparkSession.sparkContext.broadcast(vars(Vocabulary.read(path, pattern)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**sent.value))
        for batch in batches:
            for part in slices(batch, "_text", SPLIT_BYTES):
                texts = [text or "" for text in part.column("_text").to_pylist()]
                ids, starts = encoder(texts)
                own = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))
                columns = [part.column("_id"), own]
                if offsets:
                    spans = encoder.offsets(texts, ids, starts)
                    columns += [lists([s[at] for s in spans], pa.int64()) for at in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "ids", *(["starts", "ends"] if offsets else [])]
    schema = f"_id {sql_type(frame, id_col)}, ids array<int>" + ", starts array<bigint>, ends array<bigint>" * offsets
    rows = frame.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return mapped(rows, run, schema).withColumnRenamed("_id", id_col)


def characters(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens of these byte lengths start and end in ``text``, in code points."""
    raw = np.frombuffer(text.encode(), np.uint8)
    at = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return at[ends - lengths], at[ends - 1] + 1


def decode(
    frame: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", as_text: bool = False
) -> DataFrame:
    """``id_col``, ``ids``, ``decoded`` (bytes) and, with ``as_text``, ``decoded_text`` of every row.

    The bytes are exact for any list of ids, also one that starts or ends within
    a character; in ``decoded_text`` such a part reads as U+FFFD. A null list is
    an empty one. An id outside the vocabulary raises ValueError.
    """
    # Only the tokens' bytes and lengths, below 1 MB for 50,000 of them.
    sent = frame.sparkSession.sparkContext.broadcast(vars(Vocabulary.read(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary(**sent.value))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column("ids")
                values = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                # A null list has no values, so lengths tell where each row's are.
                count = np.array(pc.fill_null(pc.list_value_length(ids), 0))
                decoded = decoder(values, np.append(0, np.cumsum(count)))
                columns = [part.column("_id"), ids, pa.array(decoded, pa.binary())]
                if as_text:
                    columns.append(pa.array([r.decode("utf-8", "replace") for r in decoded], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "ids", "decoded", *(["decoded_text"] if as_text else [])]
    schema = f"_id {sql_type(frame, id_col)}, ids array<int>, decoded binary" + ", decoded_text string" * as_text
    rows = frame.select(F.col(id_col).alias("_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return mapped(rows, run, schema).withColumnRenamed("_id", id_col)


def roundtrip(
    frame: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    offsets: bool = False,
    with_ids: bool = False,
) -> DataFrame:
    """``encode``, then ``decode``, in one task, which returns digests: ``id_col``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    The digests are those of the decimal ids joined by a space, and of the bytes
    that the ids decode to, in lowercase hex. With ``offsets`` there is
    ``offsets_sha256``, of all starts and then all ends as 64-bit numbers, lowest
    byte first; with ``with_ids``, ``ids``. Rows and nulls are as in ``encode``.
    """
    sent = frame.sparkSession.sparkContext.broadcast(vars(Vocabulary.read(path, pattern)))

    def hexes(raws: Iterable[bytes]) -> pa.Array:
        return pa.array([hashlib.sha256(raw).hexdigest() for raw in raws], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(**sent.value)
        encoder, decoder, decimals = Encoder(vocabulary), Decoder(vocabulary), Decimals(len(vocabulary.size))
        for batch in batches:
            for part in slices(batch, "_text", SPLIT_BYTES):
                texts = [text or "" for text in part.column("_text").to_pylist()]
                ids, starts = encoder(texts)
                shown = (decimals(ids[s:e]) for s, e in zip(starts, starts[1:], strict=False))
                columns = [part.column("_id"), pa.array(np.diff(starts)), hexes(shown), hexes(decoder(ids.astype(np.int64), starts))]
                if offsets:
                    spans = encoder.offsets(texts, ids, starts)
                    columns.append(hexes(np.concatenate(s).astype("<i8").tobytes() for s in spans))
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["offsets_sha256"] * offsets), *(["ids"] * with_ids)]
    schema = f"_id {sql_type(frame, id_col)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", offsets_sha256 string" * offsets + ", ids array<int>" * with_ids
    rows = frame.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return mapped(rows, run, schema).withColumnRenamed("_id", id_col)


def digests(decoded: DataFrame, id_col: str = "doc_id", more: Sequence[str] = ()) -> DataFrame:
    """Count and SHA-256 of what ``decode`` gives, and ``more`` of its columns."""
    return decoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
