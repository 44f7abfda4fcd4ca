"""Exact ranked lexical search over posting lists in blocks of similar documents.

A document's score for an item is the sum, over the item's terms with repeats, of weight * ((10^9 tf) div (1000 tf + 12 m)), where m follows the document's length; all
impacts are whole numbers that 64-bit floats hold exactly.

Documents are tokenized once into a forward index of the terms that items ask for (stored; other terms only count in lengths). Each task reads its share
of that index and works on segments of bounded size. In a segment every term's posting list is cut into blocks: documents are given to the most similar of
a few representatives of the list (by a small random projection of their impact vectors), and a block stores the coordinatewise maximum of its members'
vectors. An item's product with that summary bounds the score of each member, so a block is skipped only when the bound is below the score that the
item's k-th best document has so far. Members of the other blocks are scored in full, once each. Items go through their lists from the rarest term on, and
their best k are carried from segment to segment of a task; the best k of all tasks give the ranks.

Every item meets every segment, in groups of items whose terms fit a bounded vocabulary. The items are sent to all tasks in blocks of at most BLOCK_TERMS
terms, one job per block, so what is broadcast has a size bound at any number of items.

Null and empty texts have no terms: such documents do not count, such items have no result. Rows with a null doc_id or item_id take no part (the former do not count either). Documents with
equal doc_id are ranked as separate rows; of items with equal item_id the least text counts. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.terms import term_slices
from quotelake.session import work_folder

TOP = 20
BLOCK_TERMS = 4_000_000  # terms of the items sent to tasks at once: 32 MB of hashes at most
GROUP_TERMS = 4096  # terms of the items that a segment is indexed for at once
SEGMENT_ROWS = 8192
SEGMENT_ENTRIES = 1_000_000
BLOCK_ROWS = 128
SKETCH = 32

FORWARD = "doc_id long, n long, terms array<int>, tf array<int>"


class Items(NamedTuple):
    """Items as numbers: their ids, and the places of their terms in the vocabulary with the times each is asked for."""

    ids: np.ndarray
    bounds: np.ndarray  # where each item's terms begin, and their end
    terms: np.ndarray
    times: np.ndarray


class Collection(NamedTuple):
    """What scores need of all documents: their number, the number of their terms, and each term's weight."""

    documents: int
    length: int
    weights: np.ndarray


class Segment(NamedTuple):
    """Some documents: for each the terms it holds and their impacts, one after the other."""

    ids: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray


class Blocked(NamedTuple):
    """A term's posting list: documents block by block, and the blocks' coordinatewise maxima over the columns ``terms``."""

    rows: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray
    summary: np.ndarray


def _gather(bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of some rows, row by row, and how many each row has."""
    counts = bounds[rows + 1] - bounds[rows]
    before = np.cumsum(counts) - counts
    return np.repeat(bounds[rows] - before, counts) + np.arange(int(counts.sum())), counts


def impacts(tf: np.ndarray, n: np.ndarray, of: Collection, terms: np.ndarray) -> np.ndarray:
    m = 100 - 25 + (25 * n * of.documents) // max(of.length, 1)
    return (of.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))).astype(np.float64)


def restricted(segment: Segment, vocabulary: np.ndarray) -> Segment:
    """The segment with only the terms of a sorted vocabulary, numbered by their places in it."""
    at = np.minimum(np.searchsorted(vocabulary, segment.terms), len(vocabulary) - 1)
    keep = vocabulary[at] == segment.terms
    kept = np.concatenate(([0], np.cumsum(keep)))
    return Segment(segment.ids, kept[segment.bounds], at[keep], segment.impacts[keep])


def blocked_lists(segment: Segment, asked_with: list[np.ndarray], block_rows: int = BLOCK_ROWS, sketch: int = SKETCH) -> list[Blocked | None]:
    """Each term's posting list in blocks of similar documents. asked_with: for each term, the terms that some item asks for together with it."""
    row = np.repeat(np.arange(len(segment.ids)), np.diff(segment.bounds))
    random = np.random.default_rng(7)
    signs = random.standard_normal((len(asked_with), sketch)).astype(np.float32)
    # a document's impact vector in a few random directions, of unit length
    drawn = np.zeros((len(segment.ids), sketch), np.float32)
    scale = max(float(segment.impacts.max(initial=1.0)), 1.0)
    full = np.flatnonzero(np.diff(segment.bounds))
    if len(full):
        drawn[full] = np.add.reduceat(signs[segment.terms] * (segment.impacts / scale).astype(np.float32)[:, None], segment.bounds[full], axis=0)
    drawn /= np.maximum(np.linalg.norm(drawn, axis=1, keepdims=True), 1e-9)
    by_term = np.argsort(segment.terms, kind="stable")
    cuts = np.searchsorted(segment.terms[by_term], np.arange(len(asked_with) + 1))
    column = np.full(len(asked_with), -1, np.int64)
    lists: list[Blocked | None] = []
    for term, columns in enumerate(asked_with):
        rows = row[by_term[cuts[term] : cuts[term + 1]]]
        if not len(rows):
            lists.append(None)
            continue
        blocks = -(-len(rows) // block_rows)
        if blocks > 1:
            heads = drawn[rows[np.linspace(0, len(rows) - 1, blocks).astype(np.int64)]]
            nearest = (drawn[rows] @ heads.T).argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            rows, sizes = rows[order], np.bincount(nearest, minlength=blocks)
            sizes = sizes[sizes > 0]
        else:
            sizes = np.array([len(rows)])
        column[columns] = np.arange(len(columns))
        entries, counts = _gather(segment.bounds, rows)
        block = np.repeat(np.repeat(np.arange(len(sizes)), sizes), counts)
        place = column[segment.terms[entries]]
        used = place >= 0
        summary = np.zeros(len(sizes) * len(columns))
        np.maximum.at(summary, block[used] * len(columns) + place[used], segment.impacts[entries][used])
        column[columns] = -1
        lists.append(Blocked(rows, np.concatenate(([0], np.cumsum(sizes))), columns, summary.reshape(len(sizes), -1)))
    return lists


class Best:
    """The k best documents of an item so far."""

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0)

    def least(self) -> float:
        """The score below which nothing can enter any more."""
        return float(self.scores.min()) if len(self.scores) == self.k else 1.0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least()
        ids, scores = np.concatenate((self.ids, ids[good])), np.concatenate((self.scores, scores[good]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def search(segment: Segment, lists: list[Blocked | None], terms: np.ndarray, times: np.ndarray, best: Best) -> int:
    """Add the segment's documents to an item's best; returns how many were scored in full."""
    asked = np.zeros(len(lists))
    asked[terms] = times
    seen, scored = np.zeros(len(segment.ids), bool), 0
    own = sorted((blocked for t in terms if (blocked := lists[t]) is not None), key=lambda blocked: len(blocked.rows))
    for blocked in own:
        bound = blocked.summary @ asked[blocked.terms]
        order = np.argsort(-bound, kind="stable")
        at, step = 0, 1
        # the best blocks first, in growing steps: the bar rises before the next step is judged
        while at < len(order):
            chosen = order[at : at + step]
            chosen = chosen[bound[chosen] >= best.least()]
            if not len(chosen):
                break
            rows = blocked.rows[_gather(blocked.bounds, chosen)[0]]
            rows = rows[~seen[rows]]
            seen[rows] = True
            if len(rows):
                entries, counts = _gather(segment.bounds, rows)
                sums = np.concatenate(([0.0], np.cumsum(segment.impacts[entries] * asked[segment.terms[entries]])))
                ends = np.cumsum(counts)
                best.add(segment.ids[rows], sums[ends] - sums[ends - counts])
                scored += len(rows)
            at, step = at + step, step * 4
    return scored


def grouped(items: Items, most_terms: int) -> list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Items in groups whose terms fit ``most_terms`` (or one item, if it asks for more): items, sorted terms, and for each
    the terms asked for with it, as places in the group."""
    groups, own, known = [], [], set()
    for k in range(len(items.ids)):
        terms = set(items.terms[items.bounds[k] : items.bounds[k + 1]].tolist())
        if own and len(known | terms) > most_terms:
            groups.append((own, known))
            own, known = [], set()
        own.append(k)
        known |= terms
    if own:
        groups.append((own, known))
    made = []
    for own, known in groups:
        vocabulary = np.array(sorted(known), np.int64)
        with_it: list[set[int]] = [set() for _ in vocabulary]
        for k in own:
            places = np.searchsorted(vocabulary, items.terms[items.bounds[k] : items.bounds[k + 1]]).tolist()
            for p in places:
                with_it[p].update(places)
        made.append((np.array(own), vocabulary, [np.array(sorted(w), np.int64) for w in with_it]))
    return made


def _segments(batches: Iterator[pa.RecordBatch], of: Collection, rows: int, entries: int) -> Iterator[Segment]:
    """Segments of bounded rows and entries (or one document, if it has more)."""
    for batch in batches:
        lists = batch.column("terms")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        terms, tf = (batch.column(c).values.to_numpy().astype(np.int64) for c in ("terms", "tf"))
        ids, n = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
        first = 0
        while first < len(ids):
            last = int(np.searchsorted(bounds, bounds[first] + entries, "right")) - 1
            last = min(max(last, first + 1), first + rows, len(ids))
            own = slice(bounds[first], bounds[last])
            lengths = np.repeat(n[first:last], np.diff(bounds[first : last + 1]))
            yield Segment(ids[first:last], bounds[first : last + 1] - bounds[first], terms[own], impacts(tf[own], lengths, of, terms[own]))
            first = last


def _forward(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (terms with repeats), terms (places in the vocabulary, rising) and tf of documents with at least one term. Stored."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for t in term_slices(batch.column("text")):
                n = np.diff(t.bounds)
                hashes = W.span_hashes(t.data, t.starts, t.ends)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                own = np.repeat(np.arange(t.last - t.first), n)[hit]
                cells, tf = np.unique(own * len(known) + at[hit], return_counts=True)
                text, term = cells // len(known), cells % len(known)
                some = np.flatnonzero(n)
                bounds = np.searchsorted(text, np.append(some, t.last - t.first))
                arrays = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32())) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[t.first + some]), pa.array(n[some]), *arrays], names=["doc_id", "n", "terms", "tf"])

    store = work_folder(spark, "forward")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(indexed, FORWARD).write.parquet(store)
    return spark.read.schema(FORWARD).parquet(store)


def _collection(forward: DataFrame, size: int) -> Collection:
    """Numbers over all documents; ``size`` document frequencies come to the driver, one per term of the items sent."""
    whole = forward.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).head()
    found = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[found.column("term").to_numpy()] = found.column("df").to_numpy()
    weights = np.floor(1000 * np.log((2.0 * whole["documents"] + 2) / (2.0 * df + 1))).astype(np.int64)
    return Collection(whole["documents"], whole["length"], weights)


def _asked(rows: list) -> tuple[Items, np.ndarray]:
    """Collected (item_id, terms as hashes) as numbers, and the vocabulary."""
    hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
    vocabulary = np.unique(np.concatenate(hashes))
    terms, times = [], []
    for own in hashes:
        places, n = np.unique(np.searchsorted(vocabulary, own), return_counts=True)
        terms.append(places)
        times.append(n)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in terms])))
    ids = np.array([r["item_id"] for r in rows], np.int64)
    return Items(ids, bounds, np.concatenate(terms), np.concatenate(times)), vocabulary


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in term_slices(batch.column("text")):
            hashes = W.span_hashes(t.data, t.starts, t.ends)
            own = [hashes[a:b].tobytes() for a, b in zip(t.bounds, t.bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(t.first, t.last - t.first), pa.array(own, pa.binary())], names=["item_id", "hashes"])


def _block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """item_id, doc_id, score: every task's best k documents for each item of a block."""
    items, vocabulary = _asked(rows)
    forward = _forward(docs, vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast((items, _collection(forward, len(vocabulary))))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, of = sent.value
        groups = grouped(items, GROUP_TERMS)
        best = [Best(k) for _ in items.ids]
        for segment in _segments(batches, of, SEGMENT_ROWS, SEGMENT_ENTRIES):
            for own, terms, with_it in groups:
                part = restricted(segment, terms)
                lists = blocked_lists(part, with_it)
                for item in own:
                    asked = slice(items.bounds[item], items.bounds[item + 1])
                    search(part, lists, np.searchsorted(terms, items.terms[asked]), items.times[asked], best[item])
        columns = [np.repeat(items.ids, [len(b.ids) for b in best]), np.concatenate([b.ids for b in best]), np.concatenate([b.scores for b in best])]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["item_id", "doc_id", "score"])

    return forward.where(F.size("terms") > 0).mapInArrow(searched, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0 of each item."""
    spark = docs.sparkSession
    once = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    asked = once.groupBy("item_id").agg(F.min("text").alias("text")).mapInArrow(_hashed, "item_id long, hashes binary").where(F.length("hashes") > 0)
    store = work_folder(spark, "items")
    asked.write.parquet(store)
    asked = spark.read.schema("item_id long, hashes binary").parquet(store)
    total = asked.agg(F.coalesce(F.sum(F.length("hashes")), F.lit(0)).alias("bytes")).head()["bytes"] // 8
    blocks = -(-total // block_terms)
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        if rows:
            found = found.unionByName(_block(docs, rows, k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
