"""Operator 3: personal data by patterns and a skip-chain conditional random field.

Four patterns find the base spans. The field then labels the tokens of a document
that hold a digit or an at sign; all other tokens carry no evidence of the four
kinds and are fixed to the label "none". Neighbouring tokens share a potential, and
so do distant ones that repeat a token or hold the same long digit string or the
same mail name: each is linked to its next occurrence, and to the first one that
lies in a base span, so that evidence is as near to the last mention as to the
second. Loopy belief propagation, in damped rounds until no message changes, spreads
what one mention shows to all others. A token outside the base spans that ends up
with a kind at high probability becomes a further span, so a number written once as
a phone number is also found where a pattern misses it.

A token can take a kind only if links connect it to a base span of that kind.
Repeats that nothing connects to evidence stay "none", however often they stand
there, and never enter the graph: only the tokens that share a link key with
evidence do, so its size follows the personal data of a text, not its numbers.

The weights are fitted on the driver by pseudo-likelihood over a bounded sample of
the documents, labelled by the patterns. Each is followed there by a second copy in
which base spans are rewritten as the patterns don't know them (digits alone, the
mail name alone) but keep their labels. So the sample holds what documents seldom
do: personal data that repeats in another form, and clean tokens that repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.common import first_by_hash, mapped, slices, sql_type

KINDS = ("email", "ip", "card", "phone")
#: Prior log potential of two linked tokens of the same label, "none" included.
LINKED = 8.0
#: The sample that the weights are fitted on: documents, code points of each, and tokens in all.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, SAMPLE_TOKENS = 1000, 20_000, 200_000
#: A message is settled when it changes by less; a document has so many rounds, and so many more for each token.
SETTLED, ROUNDS, TOKEN_ROUNDS = 1e-6, 200, 8

_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_EDGE = "\"'`.,;:!?()[]{}<>|*#$%&"


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # A mail name reaches left from its at sign, to the last mail's end at most, so the scan stays linear.
    at, done = text.find("@"), 0
    while at >= 0:
        host = _HOST.match(text, at + 1)
        if host:
            start = at
            while start > done and _LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                yield start, host.end()
                done = host.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start``, kind number and ``end`` of every span that the patterns find, in order.

    Per kind leftmost and non-overlapping; a match that fails its check is
    dropped, and the search goes on behind it.
    """
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass
class Graph:
    """The nodes and links of one or more documents; ``seen`` and ``shape`` are the evidence.

    ``direct`` counts a node's links to first base mentions by their label, and
    ``able`` tells the labels that it can take. ``beside`` counts the neighbours
    that were left out because they are "none".
    """

    spans: np.ndarray
    document: np.ndarray
    seen: np.ndarray
    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    direct: np.ndarray
    able: np.ndarray
    beside: np.ndarray


SHAPES = 14


def _shape(token: str, digits: str) -> list[float]:
    parts = token.strip(_EDGE).split(".")
    n = len(digits)
    return [
        1.0, "@" in token, n == 0, 0 < n <= 3, 3 < n <= 6, 6 < n <= 9, 9 < n <= 13, 13 < n <= 19, n > 19,
        token.startswith("+"), token.startswith("("), 13 < n <= 19 and luhn(digits),
        len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in parts),
        sum(c.isalpha() for c in token) * 2 > len(token),
    ]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _links(token: str, digits: str) -> set[str]:
    """What a distant token must share to be linked; ``digits`` are those of its base span, if it is in one.

    A token without letters says little unless it holds seven digits: years and
    amounts repeat everywhere, inside numbers as well.
    """
    plain = token.strip(_EDGE).casefold()
    lettered = any(c.isalpha() for c in plain)
    keys = {f"t{plain}"} if len(plain) >= 4 and (lettered or len(digits) >= 7) else set()
    if len(digits) >= 7:
        keys.add(f"d{digits[-7:]}")
    name = plain.split("@")[0].strip(_EDGE) if "@" in plain else plain
    if len(name) >= 5 and any(c.isalpha() for c in name):
        keys.add(f"n{name}")
    return keys


Span = tuple[int, int, int]


def _tokens(text: str, base: list[Span]) -> Iterator[tuple[re.Match, int, set[str]]]:
    """Every token with the kind of the base span that it touches, or -1, and its link keys."""
    ahead = 0
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while ahead < len(base) and base[ahead][2] <= start:
            ahead += 1
        for s, kind, e in base[ahead : ahead + 8]:
            if s < end and e > start:
                yield m, kind, _links(m.group(), _digits(text[s:e]))
                break
        else:
            yield m, -1, _links(m.group(), _digits(m.group()))


def _connected(text: str, base: list[Span]) -> set[str]:
    """The link keys that connect tokens to base spans, through any number of tokens.

    A pass adds the keys of tokens that share one; passes end when none is added.
    """
    found: set[str] = set()
    while True:
        more: set[str] = set()
        for _, kind, keys in _tokens(text, base):
            if (kind >= 0 or not found.isdisjoint(keys)) and not found.issuperset(keys):
                more |= keys - found
        if not more:
            return found
        found |= more


def _kinds_by_key(mentions: list[tuple[int, set[str]]]) -> list[set[int]]:
    """The kinds that base mentions show in each mention's connected part; a mention is a kind or -1, and its keys."""
    parent: dict[str, str] = {}

    def root(key: str) -> str:
        while parent.setdefault(key, key) != key:
            parent[key] = key = parent[parent[key]]
        return key

    for _, keys in mentions:
        first, *rest = sorted(keys) or [""]
        for key in rest:
            parent[root(key)] = root(first)
    shown: dict[str, set[int]] = {}
    for kind, keys in mentions:
        if kind >= 0 and keys:
            shown.setdefault(root(min(keys)), set()).add(kind)
    return [shown.get(root(min(keys)), set()) if keys else set() for _, keys in mentions]


def graph(texts: list[str], spans: list[list[Span]], connected: bool = False) -> Graph:
    """One graph over all these documents; no link crosses documents.

    ``connected`` holds the field to what evidence reaches: tokens that no link
    connects to a base span are left out, the others are linked to the first
    base mention as well, and can take the kinds that their part of the graph shows.
    """
    at, document, seen, shape, chain, skip, direct, able, beside = ([] for _ in range(9))
    labels = 1 + len(KINDS)
    for which, (text, base) in enumerate(zip(texts, spans, strict=True)):
        if connected and not base:
            continue
        wanted = _connected(text, base) if connected else None
        last: dict[str, int] = {}
        shown: dict[str, dict[int, int]] = {}
        mentions: list[tuple[int, set[str]]] = []
        first, before, joins = len(at), -9, False
        for m, kind, keys in _tokens(text, base):
            (start, end), node = m.span(), len(at)
            near, before = start - before <= 2, end
            if wanted is not None and kind < 0 and wanted.isdisjoint(keys):
                if near and joins:
                    beside[-1] += 1
                joins = False
                continue
            if near and joins:
                chain.append((node - 1, node))
            beside.append(int(near and not joins))
            joins = True
            flags = [0.0] * len(KINDS)
            if kind >= 0:
                flags[kind] = 1.0
                for key in keys:
                    shown.setdefault(key, {}).setdefault(kind, node)
            at.append((start, end))
            document.append(which)
            seen.append(flags)
            shape.append(_shape(m.group(), _digits(m.group())))
            mentions.append((kind, keys))
            skip += [(other, node) for other in sorted({last[key] for key in keys if key in last})]
            last |= dict.fromkeys(keys, node)
        for node, ((_, keys), kinds) in enumerate(zip(mentions, _kinds_by_key(mentions), strict=True), first):
            counts = [0.0] * labels
            for kind, _ in {(k, n) for key in keys for k, n in shown.get(key, {}).items() if n != node}:
                counts[kind + 1] += connected
            direct.append(counts)
            able.append([True, *(not connected or k in kinds for k in range(len(KINDS)))])
    return Graph(
        np.array(at, np.int64).reshape(-1, 2), np.array(document, np.int64),
        np.array(seen, float).reshape(-1, len(KINDS)), np.array(shape, float).reshape(-1, SHAPES),
        np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2),
        np.array(direct, float).reshape(-1, labels), np.array(able, bool).reshape(-1, labels), np.array(beside, float),
    )


def rewritten(text: str, base: list[Span]) -> tuple[str, list[Span]]:
    """``text`` with its base spans in forms that the patterns don't know, and where these are now.

    Numbers become their digits, addresses their mail name if that is a link key.
    """
    parts, labels, done, length = [], [], 0, 0
    for start, kind, end in base:
        if start < done:
            continue
        own = text[start:end]
        name = own.split("@")[0]
        if KINDS[kind] in ("card", "phone"):
            own = _digits(own)
        elif KINDS[kind] == "email" and f"n{name.casefold()}" in _links(name, _digits(name)) and any(c.isdigit() for c in name):
            own = name
        parts += [text[done:start], own]
        length += start - done
        labels.append((length, kind, length + len(own)))
        length += len(own)
        done = end
    return "".join([*parts, text[done:]]), labels


@dataclass
class Weights:
    """Log potentials: of evidence, of neighbours and of linked tokens, by label (0 is none)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit(texts: list[str], rounds: int = 600, step: float = 0.5, decay: float = 1e-5, seed: int = 7) -> Weights:
    """Maximum pseudo-likelihood, by gradient steps, with labels from the patterns.

    Every text is followed by its rewritten copy, whose evidence is hidden, as
    is that of 30 % of the labelled tokens of the text itself. Weights decay to
    zero, those of links between equal labels to ``LINKED``. Texts are taken in
    their order until ``SAMPLE_TOKENS`` tokens are reached. Without tokens
    nothing but the patterns will count.
    """
    labels, width = 1 + len(KINDS), len(KINDS) + SHAPES
    doubled, spans, copies, tokens = [], [], [], 0
    for text in texts:
        if tokens >= SAMPLE_TOKENS:
            break
        base = base_spans(text)
        copy, known = rewritten(text, base)
        doubled.append(f"{text}\n{copy}")
        spans.append([*base, *((s + len(text) + 1, kind, e + len(text) + 1) for s, kind, e in known)])
        copies.append(len(text))
        tokens += sum(1 for _ in _TOKEN.finditer(doubled[-1]))
    g = graph(doubled, spans)
    if not len(g.spans):
        return Weights(np.zeros((width, labels)), np.zeros((labels, labels)), np.zeros((labels, labels)))
    rng = np.random.default_rng(seed)
    truth = np.where(g.seen.any(axis=1), g.seen.argmax(axis=1) + 1, 0)
    hidden = (rng.random(len(truth)) < 0.3) | (g.spans[:, 0] > np.array(copies)[g.document])
    target = np.eye(labels)[truth]

    def around(pairs: np.ndarray) -> np.ndarray:
        total = np.zeros((len(truth), labels))
        np.add.at(total, pairs[:, 0], target[pairs[:, 1]])
        np.add.at(total, pairs[:, 1], target[pairs[:, 0]])
        return total

    x = np.hstack([g.seen * ~hidden[:, None], g.shape, around(g.chain), around(g.skip)])
    prior = np.zeros((x.shape[1], labels))
    prior[width + labels :] = LINKED * np.eye(labels)
    w, speed = prior.copy(), np.full(prior.shape, 1e-8)
    for _ in range(rounds):
        slope = x.T @ (np.exp(log_normal(x @ w)) - target) / len(x) + decay * (w - prior)
        speed += slope**2
        w -= step * slope / np.sqrt(speed)
    neighbours, linked = w[width : width + labels], w[width + labels :]
    return Weights(w[:width], (neighbours + neighbours.T) / 2, (linked + linked.T) / 2)


def log_normal(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def marginals(g: Graph, weights: Weights, rounds: int | None = None) -> np.ndarray:
    """Label probabilities of all nodes by damped loopy belief propagation. Tokens of base spans keep their kind.

    A round renews the messages that have not settled and those behind them, so a
    label may travel through a whole document, and settled parts cost nothing.
    Rounds are bounded by ``rounds``, or else by each document's own tokens; what
    a document gets does not depend on the others.
    """
    unary = np.hstack([g.seen, g.shape]) @ weights.unary
    unary += g.direct @ weights.skip + g.beside[:, None] * weights.chain[0]
    unary[~g.able] = -50.0
    fixed = np.flatnonzero(g.seen.any(axis=1))
    unary[fixed] = -50.0
    unary[fixed, g.seen[fixed].argmax(axis=1) + 1] = 0.0
    pairs = np.vstack([g.chain, g.skip])
    if not len(pairs):
        return np.exp(log_normal(unary))
    n, m = len(pairs), len(g.chain)
    source, target = np.r_[pairs[:, 0], pairs[:, 1]], np.r_[pairs[:, 1], pairs[:, 0]]
    is_skip = np.r_[np.arange(n) >= m, np.arange(n) >= m].astype(np.int64)
    potential = np.stack([weights.chain, weights.skip])
    by_source = source.argsort(kind="stable")
    begin = np.searchsorted(source[by_source], np.arange(len(unary) + 1))
    most = ROUNDS + TOKEN_ROUNDS * np.bincount(g.document)[g.document[source]] if rounds is None else np.full(2 * n, rounds)
    message = np.zeros((2 * n, unary.shape[1]))
    belief = unary.copy()
    active, done = np.arange(2 * n), 0
    while len(active := active[most[active] > done]):
        back = np.where(active < n, active + n, active - n)
        inner = (belief[source[active]] - message[back])[:, :, None] + potential[is_skip[active]]
        top = inner.max(axis=1)
        sent = log_normal(top + np.log(np.exp(inner - top[:, None, :]).sum(axis=1)))
        change = 0.5 * (sent - message[active])
        message[active] += change
        np.add.at(belief, target[active], change)
        moved = active[np.abs(change).max(axis=1) >= SETTLED]
        reached = np.unique(target[moved])
        count = begin[reached + 1] - begin[reached]
        behind = by_source[np.repeat(begin[reached] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        active, done = np.union1d(moved, behind), done + 1
    np.add.at(unary, target, message)
    return np.exp(log_normal(unary))


def spans_of(texts: list[str], weights: Weights, sure: float = 0.9) -> tuple[list[list], list[list]]:
    """Base spans and all spans of each text; a span is start, kind number, end."""
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    g = graph(texts, base, connected=True)
    if not len(g.spans):
        return base, every
    p = marginals(g, weights)
    label = p.argmax(axis=1)
    for i in np.flatnonzero((label > 0) & (p.max(axis=1) >= sure) & ~g.seen.any(axis=1)):
        text, (start, end) = texts[g.document[i]], g.spans[i].tolist()
        token = text[start:end]
        start, end = start + len(token) - len(token.lstrip(_EDGE)), end - len(token) + len(token.rstrip(_EDGE))
        if start < end and not any(s < end and e > start for s, _, e in base[g.document[i]]):
            every[g.document[i]].append((start, int(label[i]) - 1, end))
    return base, [sorted(spans) for spans in every]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Weights:
    """Weights from the sample: the documents with a digit or an at sign that come first by a hash of their id.

    At most ``SAMPLE_DOCUMENTS`` texts of at most ``SAMPLE_CHARS`` code points
    reach the driver. Labels are not read.
    """
    text = F.col(text_col)
    able = docs.where((F.length(text) <= SAMPLE_CHARS) & text.rlike("[0-9@]"))
    rows = able.select(text.alias("_text"), F.col(id_col).alias("_id"))
    # Documents with neither digit nor at sign make the first look fall short; the next one is as much wider as needed.
    sample = first_by_hash(rows, "pii", F.col("_id"), SAMPLE_DOCUMENTS, docs.count(), ["_text"], times=16)
    return fit(sample["_text"].to_pylist())


def personal_data(
    docs: DataFrame, weights: Weights | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``base`` and ``spans`` of every row: arrays of start, kind and end, in order.

    Offsets are code points, ends exclusive. All base spans are among the
    spans. A null or empty text has none. Rows are kept as they come, repeated
    or with a null id; further columns are not read. Without ``weights`` the
    field is fitted first.
    """
    weights = weights or train(docs, id_col, text_col)
    span = "array<struct<start:bigint,kind:string,end:bigint>>"

    def column(spans: list[list[tuple[int, int, int]]]) -> pa.Array:
        flat = [s for each in spans for s in each]
        start, end = (pa.array([s[i] for s in flat], pa.int64()) for i in (0, 2))
        fields = [start, pa.array([KINDS[s[1]] for s in flat], pa.string()), end]
        ends = np.cumsum([0, *map(len, spans)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "kind", "end"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = [t or "" for t in part.column("_text").to_pylist()]
                base, every = spans_of(texts, weights)
                yield pa.RecordBatch.from_arrays([part.column("_id"), column(base), column(every)], ["_id", "base", "spans"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = mapped(rows, run, f"_id {sql_type(docs, id_col)}, base {span}, spans {span}")
    return found.withColumnRenamed("_id", id_col)


def shown(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        id_col, *counts, F.sha2(shown("base").cast("binary"), 256).alias("base_sha256"), shown("spans").alias("spans")
    )


def redacted(
    docs: DataFrame, weights: Weights | None = None, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars"
) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, and ``length_col``, if there is one, renewed.

    Overlapping spans are replaced together, by the kind of the first. All
    columns and rows are kept; a null text stays null, with its length as it was.
    """
    weights = weights or train(docs, id_col, text_col)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                _, every = spans_of([t or "" for t in texts], weights)
                cleaned = [t and replaced(t, spans) for t, spans in zip(texts, every, strict=True)]
                new = {text_col: pa.array(cleaned, pa.string())}
                if length_col in columns:
                    old = part.column(length_col)
                    sizes = [o if t is None else len(t) for o, t in zip(old.to_pylist(), cleaned, strict=True)]
                    new[length_col] = pa.array(sizes, old.type)
                yield pa.RecordBatch.from_arrays([new.get(c, part.column(c)) for c in columns], columns)

    return mapped(docs, run, docs.schema)


def replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    parts, done, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done, i = end, i + 1
    return "".join([*parts, text[done:]])
