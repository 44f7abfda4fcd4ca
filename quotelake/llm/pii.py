"""Personal data by rules and a skip-chain conditional random field.

The rules find e-mail addresses, IPv4 addresses, card numbers and phone numbers. The field then looks at the words with a digit or an @
that no rule has claimed. Its nodes are all such words of a document: those inside a rule's match are known, the others get a label
(none or one of the kinds). Neighbouring nodes share a chain potential; equal or similar words anywhere in the document share a skip
potential (each is linked to the one before it of the same form or the same digits, so the edges are as many as the words). Loopy
sum-product passing of messages makes labels agree; a word whose marginal for a kind is high becomes a further span.

Weights are fitted in pieces on the words of at most ``sample_rows`` documents (those with the lowest hash of doc_id): a
multinomial logistic model for a single word, and for each sort of edge how often two labels meet over how often they would by chance.
All documents' whole texts are searched.

A null or empty text has no spans. Repeated rows are handled each by itself. Extra columns are ignored by ``find`` and kept by ``masked``;
an empty table gives an empty result. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.columns import plain
from quotelake.llm.samples import one_each, sample, within

SAMPLE_ROWS = 5000
SAMPLE_CHARS = 1 << 26
FEATURES = 512
SURE = 0.95
NEAR = 24  # characters between two neighbours of a chain

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match can only begin at the first digit of a run, so nothing is tried twice within one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_CANDIDATE = re.compile(r"[^\x20\x09-\x0D]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield "email", start, done
        at = text.find("@", at + 1)


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    return (sum(digits[-1::-2]) + sum(_DOUBLED[d] for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """What the rules find, by start and then kind."""
    if not _ANY.search(text):
        return []
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


class Nodes(NamedTuple):
    """The words of a text with a digit or an @: their places, known labels (-1: none), features and edges."""

    starts: list[int]
    ends: list[int]
    labels: np.ndarray
    features: list[list[int]]
    chain: list[tuple[int, int]]
    skips: list[tuple[int, int]]


def _core(text: str, start: int, end: int) -> tuple[int, int]:
    """The word without marks around it."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
        end -= 1
    return start, end


def _form(word: str) -> str:
    """A word's form: digits as 0, letters as a, runs of letters as one."""
    return re.sub(r"a+", "a", "".join("0" if c.isdigit() else "a" if c.isalpha() else c for c in word))


def nodes(text: str, spans: list[Span]) -> Nodes:
    starts, ends, features, keys = [], [], [], []
    at = 0
    while m := _ANY.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        word = _CANDIDATE.match(text, start)
        at = word.end()
        start, end = _core(text, start, at)
        if start == end:
            continue
        own = text[start:end]
        form, digits = _form(own), re.sub(r"\D", "", own)
        starts.append(start)
        ends.append(end)
        before = text[max(0, start - 40) : start].split()[-1:] or [""]
        named = [f"form={form[:40]}", f"digits={min(len(digits), 20)}", f"before={before[0].lower()[:20]}", f"first={own[0] if not own[0].isalnum() else form[0]}"]
        named += [f"has={c}" for c in "@.+-()" if c in own]
        features.append([0, *[1 + zlib.crc32(name.encode()) % (FEATURES - 1) for name in named]])
        keys.append((own.lower(), form, digits if len(digits) >= 7 else None))
    labels = np.full(len(starts), -1)
    for kind, first, last in reversed(spans):
        k = int(np.searchsorted(ends, first, "right"))
        while k < len(starts) and starts[k] < last:
            labels[k] = LABELS.index(kind)
            k += 1
    chain = [(k - 1, k) for k in range(1, len(starts)) if starts[k] - ends[k - 1] <= NEAR]
    skips: set[tuple[int, int]] = set()
    last_of: dict[tuple[int, str], int] = {}
    for k, key in enumerate(keys):
        for sort, part in enumerate(key):
            if part is not None:
                if (sort, part) in last_of:
                    skips.add((last_of[sort, part], k))
                last_of[sort, part] = k
    return Nodes(starts, ends, labels, features, chain, sorted(skips))


class Field(NamedTuple):
    """Log potentials: of words by feature and label, of chain edges and of skip edges by two labels."""

    words: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fitted(texts: list[str], steps: int = 200) -> Field:
    found = [nodes(text, base_spans(text)) for text in texts]
    features = [f for n in found for f in n.features]
    labels = [np.maximum(n.labels, 0) for n in found]
    size = len(LABELS)
    words = np.zeros((FEATURES, size))
    if features:
        rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
        columns = np.concatenate([np.array(f) for f in features])
        target = np.eye(size)[np.concatenate(labels)]
        rate = 1.0
        for _ in range(steps):
            logits = np.zeros((len(features), size))
            np.add.at(logits, rows, words[columns])
            gap = target - _softmax(logits)
            gradient = np.zeros_like(words)
            np.add.at(gradient, columns, gap[rows])
            words += rate * (gradient / len(features) - 1e-4 * words)
    return Field(words, _potential(found, labels, "chain"), _potential(found, labels, "skips"))


def _potential(found: list[Nodes], labels: list[np.ndarray], edges: str) -> np.ndarray:
    size = len(LABELS)
    met = np.full((size, size), 0.5)
    for n, own in zip(found, labels, strict=True):
        for i, j in getattr(n, edges):
            met[own[i], own[j]] += 0.5
            met[own[j], own[i]] += 0.5
    share = met / met.sum()
    alone = share.sum(axis=1)
    return np.log(share) - np.log(alone)[:, None] - np.log(alone)[None, :]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def marginals(n: Nodes, field: Field, rounds: int = 30, damping: float = 0.5) -> np.ndarray:
    """The label probabilities of each node after loopy sum-product message passing."""
    size, count = len(LABELS), len(n.starts)
    alone = np.array([field.words[f].sum(axis=0) for f in n.features]).reshape(count, size)
    known = n.labels >= 0
    alone[known] = np.where(np.eye(size, dtype=bool)[n.labels[known]], 0.0, -40.0)
    edges = np.array([*n.chain, *n.skips], int).reshape(-1, 2)
    if not len(edges):
        return _softmax(alone)
    pair = np.concatenate((np.repeat(field.chain[None], len(n.chain), 0), np.repeat(field.skip[None], len(n.skips), 0)))
    # each edge both ways; the message of k runs back as that of k + len(edges)
    source, target = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
    pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
    back = np.roll(np.arange(len(source)), len(edges))
    messages = np.zeros((len(source), size))
    for _ in range(rounds):
        total = alone.copy()
        np.add.at(total, target, messages)
        sent = (total[source] - messages[back])[:, :, None] + pair
        top = sent.max(axis=1)
        new = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        change = np.abs(new - messages).max()
        messages = damping * messages + (1 - damping) * new
        if change < 1e-4:
            break
    total = alone.copy()
    np.add.at(total, target, messages)
    return _softmax(total)


def all_spans(text: str, field: Field, sure: float = SURE) -> tuple[list[Span], list[Span]]:
    """The rules' spans, and all spans."""
    base = base_spans(text)
    if not _ANY.search(text):
        return base, base
    n = nodes(text, base)
    if not (n.labels < 0).any():
        return base, base
    chances = marginals(n, field)
    best = chances.argmax(axis=1)
    added: list[Span] = []
    for k in np.flatnonzero((n.labels < 0) & (best > 0) & (chances.max(axis=1) >= sure)):
        kind, start, end = LABELS[best[k]], n.starts[k], n.ends[k]
        if added and added[-1][0] == kind and text[added[-1][2] : start] == " ":
            start = added.pop()[1]
        added.append((kind, start, end))
    return base, sorted([*base, *added], key=_order)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    chosen = sample(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id", sample_rows, 3)
    # sample_rows is a parameter, so the broadcast has a bound
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.col("text").rlike("[0-9@]"))
    texts = within(one_each(texts, "doc_id", "text"), "doc_id", "text", SAMPLE_CHARS)
    return fitted([row["text"] for row in texts.orderBy("doc_id").collect()])


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document: counts of the rules' spans, their digest, all spans, and how many the field has added."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FOUND.split(", ")]
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                base, spans = all_spans(text.as_py() or "", field)
                kinds = [kind for kind, _, _ in base]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*map(kinds.count, KINDS), digest, written(spans), len(spans) - len(base)))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True) if rows else [()] * 7, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(searched, FOUND)


def masked(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans are replaced as one. n_chars, if there, follows."""

    def hidden(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if text is None else _hidden(text, all_spans(text, field)[1]) for text in batch.column("text").to_pylist()]
            names = batch.schema.names
            batch = batch.set_column(names.index("text"), batch.schema.field("text"), pa.array(texts, batch.column("text").type))
            if "n_chars" in names:
                lengths = pa.array([None if text is None else len(text) for text in texts], batch.column("n_chars").type)
                batch = batch.set_column(names.index("n_chars"), batch.schema.field("n_chars"), lengths)
            yield batch

    named = plain(docs, "text", "n_chars")
    return named.mapInArrow(hidden, named.schema).toDF(*docs.columns)


def _hidden(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])
