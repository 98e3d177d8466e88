"""Packing against the tokenizer's library, exhaustive subset sums and an independent walk over all pieces."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from ratewatch.llm import common, packing, queries

PATH = public.path("word_bpe_49k.json")
AWKWARD = [
    None, "", " ", "It's WE'LL 'Tis 12 345", "naïve Œuvre ½ ² µ İ Σας ΣΑΣ", "日本語 한국어 á e ́x", "🙂🙃 ​\x1c\x1d a\x1fb\x85c\xa0d e",
    "<|endoftext|> x<|startoftext|>y <|endoftext|", "a" * 300, "word " * 9000, "\n\t\r\x0b\x0c x\n\ny", "\x00\x7f�",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def laid_out(counts: dict[int, int], window: int):
    """Parts of all pieces as the plan places them: row, start, length, sequence, offset."""
    made = packing.plan(counts, window)
    length = np.repeat(list(counts), list(counts.values())).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in counts.values()]).astype(np.int64)
    return made, length, np.concatenate([np.stack(p) for p in packing.placed(made.arrays(), length, rank)], axis=1)


def assert_packed(parts, window: int) -> None:
    """``parts``: sequence, offset and length. Sequences are gapless and full, but a few at falling powers of two."""
    inside = defaultdict(list)
    for sequence, offset, length in parts:
        inside[sequence].append((offset, length))
    sizes = []
    for sequence in range(len(inside)):
        end = 0
        for offset, length in sorted(inside[sequence]):
            assert offset == end and length > 0
            end += length
        sizes.append(end)
    ids = sum(sizes)
    assert sizes.count(window) >= ids // window
    rest = [s for s in sizes if s != window]
    assert all(s & (s - 1) == 0 for s in rest) and rest == sorted(set(rest), reverse=True)


@pytest.mark.parametrize("seed", range(60))
def test_plan_fills_every_window(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 7, 8, 16, 100])
    counts = {rng.randint(1, window): rng.randint(1, 30) for _ in range(rng.randint(1, 8))}
    _, length, (row, start, size, sequence, offset) = laid_out(counts, window)
    assert_packed(zip(sequence.tolist(), offset.tolist(), size.tolist(), strict=True), window)
    covered = defaultdict(int)
    for i, s, n in sorted(zip(row.tolist(), start.tolist(), size.tolist(), strict=True)):
        assert covered[i] == s
        covered[i] += n
    assert [covered[i] for i in range(len(length))] == length.tolist()


def test_one_length_for_all():
    made, _, (row, _, size, sequence, offset) = laid_out({3000: 30_000}, 4096)
    assert_packed(zip(sequence.tolist(), offset.tolist(), size.tolist(), strict=True), 4096)
    assert len(made.length) < 300


def test_plan_grows_with_lengths_not_with_pieces():
    few, many = (packing.plan({k: n + k % 7 for k in range(1, 257)}, 256) for n in (10**3, 10**9))
    assert many.sequences > 10**5 * few.sequences
    assert len(many.length) < 20 * len(few.length)


@pytest.mark.parametrize("seed", range(40))
def test_best_fill_is_the_best_subset(seed):
    rng = random.Random(seed)
    items = [rng.randint(3, 40) for _ in range(rng.randint(1, 9))]
    room = rng.randint(1, 90)
    left = Counter(items)
    used = packing.best_fill(room, sorted(left), left)
    best = max(sum(c) for n in range(len(items) + 1) for c in combinations(items, n) if sum(c) <= room)
    assert sum(length * n for length, n in used.items()) == best
    assert all(0 < n <= left[length] for length, n in used.items())


def test_cuts_only_where_no_multiset_fills():
    _, _, (row, *_) = laid_out({5: 10, 3: 4, 2: 8, 8: 4}, 10)
    assert len(row) == len(set(row.tolist()))


def test_words_encode_as_whole_texts(library):
    saved = library.to_str()
    assert packing.parts_at_spaces(saved)
    encode = packing.Encoder(saved)
    rng = random.Random(5)
    signs = "aAéÉßẞİıΣς'sTt1٣½ \n\t\x0b\x1c\x85\xa0 　.,-_̧́日🙂ﬁ<|endoftext|>"
    texts = [t or "" for t in AWKWARD] + ["".join(rng.choice(signs) for _ in range(80)) for _ in range(400)]
    whole = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(raw, packing.ID).tolist() for raw in encode(texts)] == whole


def test_blocks_and_a_full_memory(library, monkeypatch):
    monkeypatch.setattr(common, "REMEMBERED", 6)
    text = " ".join(f"w{i % 50} {'x' * (i % 70)}\n" for i in range(2000))
    assert "".join(packing.blocks(text, 100)) == text
    monkeypatch.setattr(packing, "BLOCK_CHARS", 100)
    monkeypatch.setattr(packing.blocks, "__defaults__", (100,))
    encode, whole = packing.Encoder(library.to_str()), library.encode(text, add_special_tokens=False).ids
    for raw in encode([text, "", text]):
        assert np.frombuffer(raw, packing.ID).tolist() in (whole, [])


def test_other_tokenizers_take_whole_texts():
    saved = Tokenizer.from_file(public.path("byte_bpe_50k.json")).to_str()
    assert not packing.parts_at_spaces(saved)
    ids = np.frombuffer(packing.Encoder(saved)(["two  words"])[0], packing.ID).tolist()
    assert ids == Tokenizer.from_str(saved).encode("two  words").ids


def assert_holds_all(rows, given, library, window: int, end_id: int) -> None:
    """Every document's ids, each in exactly one piece; ``given`` has unique ids."""
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert by_id.keys() == dict(given).keys()
    for i, text in given:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        end = 0
        for r in sorted(by_id[i], key=lambda r: r["start"]):
            assert r["start"] == end and r["doc_tokens"] == len(ids)
            end += r["length"]
            raw = np.array(ids[r["start"] : end], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(raw)
        assert end == len(ids)
    assert_packed([(r["sequence_id"], r["offset"], r["length"]) for r in rows], window)


def test_packed_documents(spark, documents, prose, library):
    given = [(i, t) for i, t in enumerate(AWKWARD)] + [(100 + i, prose(i, 10 + 37 * i)) for i in range(40)] + [(None, "no id")]
    frame = packing.packed(documents(given).repartition(5), PATH, window=512, end_id=2)
    rows = [r.asDict() for r in packing.digests(frame).collect()]
    assert_holds_all(rows, given, library, 512, 2)
    joined = {r["sequence_id"]: (r["length"], bytes(r["ids"])) for r in packing.sequences(frame).collect()}
    # The plan is made anew, so the second run may place pieces otherwise; each run is whole.
    assert sum(n for n, _ in joined.values()) == sum(r["length"] for r in rows)
    assert all(len(raw) == 4 * n for n, raw in joined.values())


def test_repeated_rows_and_empty_tables(spark, documents, library):
    given = [(1, "the same text")] * 30 + [(None, None)] * 3
    rows = packing.packed(documents(given), PATH, window=16).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 3
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 30 * 4
    assert_packed([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 16)
    assert packing.packed(documents([]), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.packed(documents([]), PATH, window=0)


def test_query_on_the_given_documents(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in queries.op11_packing(spark, sf_dir).collect()]
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert_holds_all(rows, given, library, 4096, 2)
