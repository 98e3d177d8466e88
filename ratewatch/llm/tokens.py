"""Operator 8: token counts by the whole-token shortcut.

On the driver, every string of the vocabulary is encoded alone. Those that give
one token are proven: a pre-token's merges depend on its own bytes only, so such
a string counts as one wherever it is a pre-token. On the executors, texts are
split into pre-tokens; the proven ones are counted at once, and only the others
are merged.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratewatch.llm.bpe import PATTERN, as_characters, byte_characters, splitter, unsettled_characters
from ratewatch.llm.common import REMEMBERED, REMEMBERED_CHARS, mapped, slices, sql_type


class Memo(dict):
    """Counts of pre-tokens: the given ones, and others as they are first met, up to a bound."""

    def __init__(self, given: dict, value: Callable[[str], int]):
        super().__init__(given)
        self.given, self.value, self.most = given, value, len(given) + REMEMBERED

    def __missing__(self, word: str) -> int:
        value = self.value(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= self.most:
                self.clear()
                self.update(self.given)
            self[word] = value
        return value


def proven(saved: str) -> set[str] | None:
    """The strings that alone give one token; None if texts need more than byte-level pre-tokens and merges."""
    config = json.loads(saved)
    before, model = config.get("pre_tokenizer") or {}, config["model"]
    plain = (
        config.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        and not any(t[k] for t in config["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        return None
    byte = {c: b for b, c in enumerate(byte_characters())}
    added = {t["content"] for t in config["added_tokens"]}
    texts = []
    for token in model["vocab"]:
        try:
            texts.append(bytes(byte[c] for c in token).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    tokenizer = Tokenizer.from_str(saved)
    alone = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return {text for text, e in zip(texts, alone, strict=True) if len(e.ids) == 1 and text not in added}


def counter(saved: str, known: set[str] | None, unsettled: str):
    """Count of one text's tokens."""
    tokenizer = Tokenizer.from_str(saved)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def by_library(text: str) -> int:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    if known is None:
        return by_library
    model, shown = tokenizer.model, dict(enumerate(byte_characters()))
    costs = Memo(dict.fromkeys(known, 1), lambda word: len(model.tokenize(as_characters(word.encode(), shown))))
    split, unsettled = splitter(PATTERN), regex.compile(unsettled)
    added = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    special = regex.compile("|".join(map(regex.escape, added))) if added else None

    def count(text: str) -> int:
        if not text.isascii() and unsettled.search(text):
            return by_library(text)
        if special is None or not special.search(text):
            return sum(map(costs.__getitem__, split(text)))
        parts = special.split(text)
        return len(parts) - 1 + sum(costs[word] for part in parts for word in split(part))

    return count


def pieces(model: bytes):
    """Count of one text's tokens by a sentencepiece model."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return lambda text: len(processor.encode(text, num_threads=1))


def token_counts(
    frame: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row.

    ``path`` names a ``tokenizers`` file (.json) or a sentencepiece model
    (.model), read on the driver and broadcast. Counts are those of the library
    without begin, end or added special tokens, truncation or padding; strings of
    special tokens inside a text count as the library takes them. The shortcut
    serves byte-level BPE files; other models are counted by their library. A
    null text is an empty one: 0 bytes, 0 tokens. Rows are kept as they come,
    repeated or with a null id; further columns are not read. A task keeps the
    counts of pre-tokens that it has merged.
    """
    with open(path, "rb") as file:
        raw = file.read()
    whole = path.endswith(".model")
    known = None if whole else proven(raw.decode())
    sent = frame.sparkSession.sparkContext.broadcast({"model": raw, "known": known, "unsettled": unsettled_characters()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept = sent.value
        saved = kept["model"]
        count = pieces(saved) if whole else counter(saved.decode(), kept["known"], kept["unsettled"])
        for batch in batches:
            for part in slices(batch, "_text"):
                n = [count(text) if text else 0 for text in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_bytes"), pa.array(n, pa.int64())], names)

    names = ["_id", "n_bytes", "n_tokens"]
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    rows = frame.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), size.alias("_bytes"))
    counted = mapped(rows, run, f"_id {sql_type(frame, id_col)}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("_id", id_col)
