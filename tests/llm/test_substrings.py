"""Substring deduplication against a plain pass over all spans in order."""

from __future__ import annotations

import re

import numpy as np
import pytest

from ratewatch.llm import substrings as S


def cut(text):
    """Byte start, byte end and words of every sentence of a text."""
    raw = text.encode()
    found = S.sentences([raw])
    starts, ends = found.word_start[found.first], found.word_end[found.after - 1]
    return [(a, b, raw[a:b].split()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def plain_cut(text):
    """The same by a loop over words and the white space behind them."""
    raw, out, held = text.encode(), [], []
    words = list(re.finditer(rb"[^ \t-\r]+", raw))
    for n, m in enumerate(words):
        held.append(m)
        gap = raw[m.end() : words[n + 1].start()] if n + 1 < len(words) else b"\n"
        if m.group()[-1:] in b".!?" or b"\n" in gap:
            out.append(held)
            held = []
    return out


def plain(rows):
    """Removed sentence numbers of each distinct document, by a dictionary of first places."""
    documents = sorted({(i is not None, i or 0, S_hash(t), t) for i, t in rows if t is not None}, key=lambda d: d[:3])
    first, gone = {}, {}
    for known, i, _, text in documents:
        found = cut(text)
        removed = set()
        for a in range(len(found)):
            b = next((b for b in range(a + S.RUN, len(found) + 1) if sum(len(f[2]) for f in found[a:b]) >= S.WORDS), None)
            if b is None:
                break
            words = tuple(w for f in found[a:b] for w in f[2])
            if words in first:
                removed |= set(range(a, b))
            else:
                first[words] = (known, i)
        gone[i if known else None, text] = removed
    return gone


def S_hash(text):
    import xxhash

    return (xxhash.xxh64_intdigest(text.encode(), 42) + 2**63) % 2**64 - 2**63


def passage(prose, n):
    return " ".join(prose(1000 + n, 60).split())


def corpus(prose):
    shared = [passage(prose, n) for n in range(3)]
    rows = [(i, prose(i, 80)) for i in range(30)]
    rows += [(100 + i, prose(200 + i, 30) + "\n" + shared[i % 3] + "\n" + prose(300 + i, 30)) for i in range(12)]
    rows += [(200 + i, "no stops here " + " ".join(prose(400 + i, 40).replace(".", "").split()) + " " + shared[0].replace(".", "") + " end " + prose(500 + i, 9).replace(".", "")) for i in range(4)]
    rows += [(300, prose(3, 80)), (301, shared[1] + "\n" + shared[1]), (302, ""), (303, None), (304, "One. Two."), (305, "  \n\n ")]
    rows += [(None, shared[2]), (101, prose(201, 30) + "\n" + shared[1] + "\n" + prose(301, 30)), (5, "other " + prose(7, 50)), (306, "The. Of. And. The. Of. And.")]
    return rows, shared


TEXTS = ["a.b c! d\n\ne? f", " \n x", "w " * 500, "¿qué? ñandú. 🙂 ok.\n", "Same Same " * 90, "", "\x0b\x1c a\xa0b"]


def test_sentences_cover_the_text(prose):
    for text in [prose(1, 100), prose(2, 200).replace(".", ""), *TEXTS]:
        found = cut(text)
        assert [w for _, _, words in found for w in words] == text.encode().split()
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))
        assert all(1 <= len(words) <= S.MOST for _, _, words in found)
        # Short sentences are those of the plain reading; long ones are cut within.
        ends = {b for _, b, _ in found}
        assert all(held[-1].end() in ends for held in plain_cut(text))
        short = {(h[0].start(), h[-1].end()) for h in plain_cut(text) if len(h) <= S.LONG}
        assert short <= {(a, b) for a, b, _ in found}


def test_texts_are_cut_alone_as_together(prose):
    texts = [t.encode() for t in [prose(1, 100), *TEXTS, prose(1, 100), "x " + prose(1, 100)]]
    together = S.spans(texts)
    for i, text in enumerate(texts):
        alone, own = S.spans([text]), np.flatnonzero(together.text == i)
        for name in ("first", "after", "h", "g"):
            assert getattr(together, name)[own].tolist() == getattr(alone, name).tolist()
    assert len(set(S.spans(texts[:1]).h) & set(S.spans(texts[-1:]).h)) >= 5


def test_against_plain(documents, prose):
    rows, _ = corpus(prose)
    got = S.deduplicated(documents(rows)).collect()
    assert len(got) == len(rows)
    gone = plain(rows)
    results = {}
    for r in got:
        results.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        removed = gone.get((i, text), set())
        kept = None if text is None else [w for n, f in enumerate(cut(text)) if n not in removed for w in f[2]]
        match = [
            r for r in results[i]
            if r["n_removed"] == len(removed) and (r["text"].encode().split() if r["text"] is not None else None) == kept
        ]
        assert match, (i, len(removed), results[i])
        if text is not None:
            left, done = [], 0
            for place in match[0]["removed"]:
                left.append(text[done : place["start"]])
                done = place["end"]
            assert "".join([*left, text[done:]]) == match[0]["text"]


def test_rows_alike_keep_one_whole(documents, prose, monkeypatch):
    """Against the plain pass, in which every further row is a later document."""
    monkeypatch.setattr(S, "COPIES", 4)
    shared = passage(prose, 1)
    alone, inner = prose(1, 80), prose(2, 30) + "\n" + shared + "\n" + prose(3, 30)
    given = [(1, alone), (2, shared), (3, inner), (None, prose(4, 70)), (None, "One. Two."), (5, None), (6, ""), (7, shared + "\n" + shared)]
    times = [23, 2, 3, 6, 3, 2, 2, 2]
    rows = [r for r, n in zip(given, times, strict=True) for _ in range(n)] + [(8, "single " + prose(9, 60)), (9, alone)]
    got = S.deduplicated(documents(rows).repartition(5)).collect()
    assert len(got) == len(rows)
    gone = plain(rows)
    for (i, text), n in zip([*given, *rows[-2:]], [*times, 1, 1], strict=True):
        own = sorted((r for r in got if r["doc_id"] == i and (i is not None or ("One." in r["text"]) == ("One." in text))), key=lambda r: r["n_removed"])
        assert len(own) == n
        if text is None:
            assert all(r["text"] is None for r in own)
            continue
        found, spans = cut(text), S.spans([text.encode()])
        every = {s for a, b in zip(spans.first.tolist(), spans.after.tolist(), strict=True) for s in range(a, b)}
        for k, r in enumerate(own):
            removed = every if k else gone[i, text]
            assert r["n_removed"] == len(removed)
            assert r["text"].encode().split() == [w for s, f in enumerate(found) if s not in removed for w in f[2]]
        if i == 1:
            assert own[0]["text"] == text and own[0]["sources"] == [] and all(r["sources"] == [1] for r in own[1:])
        if i == 3:
            assert own[0]["sources"] == [2] and all(r["sources"] == [2, 3] for r in own[1:])
    assert next(r for r in got if r["doc_id"] == 9)["sources"] == [1]


def test_a_third_of_the_rows_alike(documents, prose):
    rows = [(i if i % 3 else None, prose(0 if i % 3 == 0 else i, 40)) for i in range(300)]
    got = [r for r in S.deduplicated(documents(rows)).collect() if r["doc_id"] is None]
    assert len(got) == 100 and sum(r["n_removed"] == 0 for r in got) == 1


def test_a_full_map_changes_nothing(documents, prose, monkeypatch):
    rows, _ = corpus(prose)
    frame = documents(rows)
    want = sorted(map(repr, S.deduplicated(frame).collect()))
    monkeypatch.setattr(S, "repeating", lambda docs, text_col: np.full(S.SLOTS // 8, 255, np.uint8))
    assert sorted(map(repr, S.deduplicated(frame).collect())) == want


def test_passages_of_over_50_words_are_caught_once(documents, prose):
    rows, shared = corpus(prose)
    got = {r["doc_id"]: r for r in S.deduplicated(documents(rows)).collect()}
    carriers = [i for i, t in rows if t and shared[0] in t]
    for i in carriers[1:]:
        middle = " ".join(shared[0].split()[13:47])
        assert middle not in got[i]["text"] and got[i]["sources"] == [carriers[0]]
    assert got[carriers[0]]["n_removed"] == 0
    clean = [i for i in range(30) if i not in (3, 5, 7)]
    assert all(got[i]["n_removed"] == 0 and got[i]["sources"] == [] for i in clean)
    assert got[300]["text"].strip() == "" and got[300]["sources"] == [3]
    # Unpunctuated text shares the boundaries that hashes pick.
    assert all(got[200 + i]["n_removed"] >= 3 for i in range(1, 4))


def test_a_hot_passage(documents, prose):
    shared = passage(prose, 9)
    rows = [(i, f"{prose(i, 20)}\n{shared}" if i % 2 else prose(i, 40)) for i in range(400)]
    got = {r["doc_id"]: r for r in S.deduplicated(documents(rows)).collect()}
    assert sum(r["n_removed"] > 0 for r in got.values()) == 199 and got[1]["n_removed"] == 0


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "")]])
def test_nothing_to_do(documents, rows):
    assert S.deduplicated(documents(rows)).count() == len(rows)


def test_a_very_long_text(documents, prose):
    text = "word without any stop " * 20_000
    (row,) = S.deduplicated(documents([(1, text)])).collect()
    assert row["n_removed"] > 1000 and len(row["text"]) < len(text) / 10
