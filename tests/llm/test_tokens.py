"""Byte-level BPE and token counts against their libraries."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

from ratewatch.llm import bpe, tokens

RANKS = public.path("byte_bpe_50k.tiktoken")
AWKWARD = [
    "", " ", "   a", "a  b\n\n \tc", "-----" * 40, "a" * 3000, "it's we'll 'Tis", "<|endoftext|> and <|endoftext|><|endoftext|>",
    "naïve Œuvre ½ ² µ", "日本語 한국어 עברית", "🙂🙃 é ​\x1c\x85\xa0 x", "࢏౜\U00010400 9٣", "�\x00\x7f",
]


def texts():
    rng = random.Random(1)
    signs = "aA1 \n\t.'sté日🙂-_=$\xa0²"
    return [*AWKWARD, *("".join(rng.choice(signs) for _ in range(150)) for _ in range(100)), "word and number 12 " * 8000]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_ids_offsets_and_bytes(spark, documents, reference):
    given = [(i, t) for i, t in enumerate(texts())] + [(None, None), (3, "again"), (3, "again")]
    encoded = bpe.encode(documents(given), RANKS, public.PATTERN, offsets=True)
    rows = [r.asDict() for r in encoded.collect()]
    assert len(rows) == len(given)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] != 3}
    for i, text in given:
        if i is None or i == 3:
            continue
        row = by_id[i]
        assert row["ids"] == reference.encode_ordinary(text)
        raw, at = text.encode(), 0
        for token, start, end in zip(row["ids"], row["starts"], row["ends"], strict=True):
            piece = reference.decode_single_token_bytes(token)
            assert raw[at : at + len(piece)] == piece
            assert text[:start].encode() == raw[: len(text[:start].encode())]
            assert len(text[:start].encode()) <= at and len(text[:end].encode()) >= at + len(piece)
            at += len(piece)
    assert by_id[None]["ids"] == []
    decoded = {r["doc_id"]: r["decoded"] for r in bpe.decode(encoded, RANKS).collect()}
    assert all(decoded[i] == (t or "").encode() for i, t in given if i != 3)


def test_the_model_alone_splits_alike(reference):
    model = bpe.tokenizer_of(bpe.read_ranks(RANKS), public.PATTERN)
    for text in ["plain words, and 12 numbers", "aaaaaa------====", "été naïve"]:
        assert model.encode(text, add_special_tokens=False).ids == reference.encode_ordinary(text)


def test_split_characters_decode(spark):
    whole = spark.createDataFrame([(1, [8582]), (2, []), (3, None), (4, [161, 12520])], "doc_id long, ids array<int>")
    ranks = {rank: token for token, rank in bpe.read_ranks(RANKS).items()}
    out = {r["doc_id"]: r for r in bpe.decode(whole, RANKS, as_text=True).collect()}
    assert out[1]["decoded"] == ranks[8582]
    assert out[1]["decoded_text"] == ranks[8582].decode("utf-8", "replace")
    assert out[2]["decoded"] == out[3]["decoded"] == b""


def test_unknown_id_is_an_error(spark):
    frame = spark.createDataFrame([(1, [50_300])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(frame, RANKS).collect()


def test_digests(documents, reference):
    (row,) = bpe.digests(bpe.decode(bpe.encode(documents([(1, "héllo wörld")]), RANKS, public.PATTERN), RANKS)).collect()
    ids = " ".join(map(str, reference.encode_ordinary("héllo wörld")))
    assert row["ids_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256("héllo wörld".encode()).hexdigest()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(documents, name):
    path = public.path(name)
    given = [(i, t) for i, t in enumerate(texts())] + [(None, None)]
    if path.endswith(".json"):
        library = Tokenizer.from_file(path)
        library.no_truncation()
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(processor.encode(t))
    rows = {r["doc_id"]: r for r in tokens.token_counts(documents(given), path).collect()}
    for i, text in given:
        n = count(text or "")
        assert (rows[i]["n_tokens"], rows[i]["n_bytes"]) == (n, len((text or "").encode())), text
        assert rows[i]["over_limit"] == (n > 1024)


def test_proven_strings_are_one_token():
    path = public.path("byte_bpe_50k.json")
    saved = open(path).read()
    library, known = Tokenizer.from_file(path), tokens.proven(saved)
    assert len(known) > 45_000 and "<|endoftext|>" not in known
    sample = random.Random(2).sample(sorted(known), 500)
    assert all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in sample)
    assert tokens.proven(open(public.path("word_bpe_49k.json")).read()) is None


def test_empty_table(documents):
    none = documents([])
    assert bpe.decode(bpe.encode(none, RANKS, public.PATTERN, offsets=True), RANKS).count() == 0
    assert tokens.token_counts(none, public.path("byte_bpe_50k.json")).count() == 0


def test_the_memo_forgets_at_its_bound(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 2)
    memo = tokens.Memo({"a": 1}, len)
    assert [memo[w] for w in ("bb", "ccc", "dddd", "a", "bb")] == [2, 3, 4, 1, 2]
    assert len(memo) <= 3


def test_the_query_digests_what_the_library_gives(spark):
    """Ids, offsets and decoded bytes of the given documents, each as the library has them."""
    from ratewatch.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    reference = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    expected = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        raw, ids = (r["text"] or "").encode(), reference.encode_ordinary(r["text"] or "")
        begun = [0]
        for byte in raw:
            begun.append(begun[-1] + (byte & 0xC0 != 0x80))
        at, starts, ends = 0, [], []
        for token in ids:
            size = len(reference.decode_single_token_bytes(token))
            starts.append(begun[at + 1] - 1)
            ends.append(begun[at + size])
            at += size
        packed = b"".join(n.to_bytes(8, "little") for n in [*starts, *ends])
        shown = " ".join(map(str, ids)).encode()
        expected[r["doc_id"]] = (len(ids), *(hashlib.sha256(x).hexdigest() for x in (shown, raw, packed)))
    rows = queries.op5_byte_bpe(spark, sf_dir).collect()
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["offsets_sha256"]) for r in rows}
    assert found == expected and len(rows) == len(expected)


def test_the_roundtrip_is_encoding_and_decoding(documents):
    given = documents([(i, t) for i, t in enumerate(texts())] + [(None, None), (3, "again"), (3, "again")])
    whole = bpe.digests(bpe.decode(bpe.encode(given, RANKS, public.PATTERN), RANKS), more=["ids"])
    once = bpe.roundtrip(given, RANKS, public.PATTERN, with_ids=True)
    assert once.columns == whole.columns
    assert sorted(map(repr, once.collect())) == sorted(map(repr, whole.collect()))


def test_decoding_refuses_unknown_ids(spark):
    frame = spark.createDataFrame([(1, [72, 105]), (2, None), (3, [])], "doc_id long, ids array<int>")
    rows = {r["doc_id"]: r["decoded"] for r in bpe.decode(frame, RANKS).collect()}
    assert len(rows[1]) >= 2 and rows[2] == rows[3] == b""
    for unknown in (-1, 60_000, None):
        with pytest.raises(Exception, match="not in the vocabulary"):
            bpe.decode(spark.createDataFrame([(1, [unknown])], "doc_id long, ids array<int>"), RANKS).collect()
