"""Jaccard self-join of documents on word n-grams, size-aware: subsets for small sets, inverted lists for large ones.

A document's set holds its distinct n-grams of words (A to Z in lower case). Documents with equal sets form a class, and from
then on only classes are compared. Two classes link when intersection / union reaches the threshold.

* Small sets: two sets of sizes s and t link exactly if they share a subset of the size their overlap must have. Each small set
  lists its subsets of that size for each t, so sets under one subset are linked, with no further check. Only one link per set is kept, to
  the smallest class of the other size.
* First of all, a set can only link if a share of its n-grams as large as the threshold occurs in other sets too. Each task ships every n-gram of a stretch
  of its documents once, packed; where n-grams meet, those that came twice are counted for their sets. Sets with fewer are done. N-grams that agree in the
  32 bits sent beside their partition count in full, which only lets a set pass that need not. Sets are told apart by 40 bits of their keys here: a link
  is lost if two sets that share n-grams with no third agree in these (one in 10^12 such pairs).
* Large sets: n-grams have a fixed order, with those that occur in many documents last. Two sets that link share one of their first n-grams
  (as many as may be missing, and one), so each set is entered in the inverted lists of these. A list is known by its smallest class, the
  hub; the lists of a hub are scanned together, by bands of set sizes that may link, in blocks of BLOCK sets against BLOCK sets. A first scan
  looks at the beginnings of the sets only: up to the lesser of their last n-grams two beginnings are complete, so too many
  n-grams missing there rule a pair out. A second scan counts the exact overlaps of whole sets in the blocks for what is left, and gives a
  spanning forest of a block's links rather than all pairs.
* The boundary between small and large is where listing subsets starts to cost more than the lists and the sets that go with
  them, by the sizes at hand. Small sets that might link to a large one are entered in the lists too.

The links' connected components then come from star contraction. The order of n-grams only decides how long lists get, never what
links: it uses counts of the n-grams frequent in any task, over all documents.

Null and empty texts have no n-grams and link with nothing. Documents of fewer words than n have their whole word sequence as their one n-gram.
Repeated rows are equal sets. Extra columns are ignored; an empty table gives an empty result. N-grams and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quotelake.llm import words as W
from quotelake.llm.columns import plain
from quotelake.llm.components import components
from quotelake.llm.samples import commonest
from quotelake.session import work_folder

HOT = 1 << 18
HOT_IN_TASK = 4
HOT_TOKENS = 1_500_000
MOST_SMALL = 24
BLOCK = 256
SCANNED = 8192
LEAD = 1.5
PARTITION_TOKENS = 3_000_000


class Threshold(NamedTuple):
    """Links have part * union <= whole * intersection."""

    part: int
    whole: int

    def overlap(self, s: int, t: int) -> int:
        return -(-self.part * (s + t) // (self.part + self.whole))

    def partners(self, s: int) -> range:
        """The sizes that sets of size s may link with."""
        return range(-(-self.part * s // self.whole), self.whole * s // self.part + 1)

    def prefix(self, s):
        return s + (-self.part * s // self.whole) + 1

    def subsets(self, s: int) -> int:
        return sum(comb(s, self.overlap(s, t)) for t in self.partners(s) if self.overlap(s, t) <= min(s, t))


def boundary(sizes: dict[int, int], threshold: Threshold) -> int:
    """The size up to which listing subsets costs least. sizes: sets per size. A list entry costs one, and a set in a list its size."""
    best, best_cost, small = 0, 0, 0
    for s in range(1, MOST_SMALL + 1):
        small += sizes.get(s, 0) * (threshold.subsets(s) - threshold.prefix(s) - s)
        if small <= best_cost:
            best, best_cost = s, small
    return best


def grams(s: W.Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a slice's texts: text and hash, by text and then hash."""
    text, found = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(s.hashes) >= n:
        whole = np.flatnonzero(s.text[: len(s.hashes) - n + 1] == s.text[n - 1 :])
        text, found = s.text[whole], W.shingles(s.hashes, n)[whole]
    bounds = s.bounds()
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        text = np.append(text, short)
        found = np.append(found, np.concatenate([W.shingles(s.hashes[bounds[k] : bounds[k + 1]], n) for k in short]))
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    first = np.append(True, (text[1:] != text[:-1]) | (found[1:] != found[:-1])) if len(text) else np.zeros(0, bool)
    return text[first], found[first]


def set_keys(text: np.ndarray, found: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each text's set, and its size."""
    sizes = np.bincount(text, minlength=texts)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mixed(found), dtype=np.uint64)))
        ends = np.cumsum(sizes)
        keys = W.mixed(total[ends] - total[ends - sizes] + sizes.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return keys.view(np.int64), sizes


PACKED = "p int, counts boolean, a binary, b binary"
SHARED = "id long, shared long"
PARTIAL = "r int, ids binary, sums binary"
MANY = 0  # in place of a set: the n-gram is in several sets of the stretch


def short_key(key):
    """40 bits of a set's key, never 0. For numpy arrays and Spark columns of signed keys alike."""
    if isinstance(key, np.ndarray):
        return np.maximum(key.view(np.uint64) >> np.uint64(24), np.uint64(1))
    return F.greatest(F.shiftrightunsigned(key, 24), F.lit(1))


def _packed(n: int, bits: int):
    """The distinct n-grams of stretches of documents by the 2**bits partitions of their hashes: 32 more bits of each, and 40 of its set."""

    def stretch(tokens: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, bool, bytes, bytes]]:
        order = np.argsort(tokens, kind="stable")
        tokens, ids = tokens[order], ids[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        counts = np.diff(np.append(first, len(tokens)))
        several = np.repeat(counts > 1, counts)
        own, times = np.unique(ids[several], return_counts=True)
        tokens, ids = tokens[first], np.where(counts > 1, np.uint64(MANY), ids[first])
        rest = tokens if not bits else tokens << np.uint64(bits)
        rest = (rest >> np.uint64(32)).astype(np.uint32)
        parts = np.zeros(len(tokens), np.int64) if not bits else (tokens >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.searchsorted(parts, np.arange((1 << bits) + 1))
        for p in range(1 << bits):
            a, b = edges[p], edges[p + 1]
            if b > a:
                # bytes of like significance together: the leading ones of sorted numbers compress well
                yield p, False, rest[a:b].view(np.uint8).reshape(-1, 4).T.tobytes(), ids[a:b].view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()
        if len(own):
            yield int(tokens[0] % np.uint64(1 << bits)), True, own.tobytes(), times.astype(np.int64).tobytes()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens, ids, held = [], [], 0

        def out() -> pa.RecordBatch:
            rows = list(stretch(np.concatenate(tokens), np.concatenate(ids)))
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=["p", "counts", "a", "b"])

        for batch in batches:
            for s in W.word_slices(batch.column("text"), lower=True):
                text, found = grams(s, n)
                keys, sizes = set_keys(text, found, s.last - s.first)
                new = np.zeros(len(keys), bool)
                for k in np.flatnonzero(sizes):
                    if keys[k] not in seen:
                        seen.add(keys[k])
                        new[k] = True
                kept = new[text]
                tokens.append(found[kept])
                ids.append(short_key(keys)[text[kept]])
                held += len(tokens[-1])
                if held >= HOT_TOKENS:
                    yield out()
                    seen, tokens, ids, held = set(), [], [], 0
        if held:
            yield out()

    return found


def _shared(table: pa.Table, ranges: int) -> pa.Table:
    """How many n-grams of one partition each set has that are in other sets too: packed, by ranges of the sets."""
    tokens, ids, sums = [], [], [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for counts, a, b in zip(table.column("counts").to_pylist(), table.column("a").to_pylist(), table.column("b").to_pylist(), strict=True):
        if counts:
            sums.append((np.frombuffer(a, np.uint64), np.frombuffer(b, np.int64)))
        else:
            tokens.append(np.ascontiguousarray(np.frombuffer(a, np.uint8).reshape(4, -1).T).view(np.uint32).ravel())
            wide = np.zeros((len(tokens[-1]), 8), np.uint8)
            wide[:, :5] = np.frombuffer(b, np.uint8).reshape(5, -1).T
            ids.append(wide.view(np.uint64).ravel())
    if tokens:
        stretches = np.repeat(np.arange(len(tokens), dtype=np.int32), [len(t) for t in tokens])
        tokens, ids = np.concatenate(tokens), np.concatenate(ids)
        order = np.argsort(tokens, kind="stable")
        tokens, ids = tokens[order], ids[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        counts = np.diff(np.append(first, len(tokens)))
        apart = (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)) & (counts > 1)
        kept = np.repeat(apart, counts) & (ids != MANY)
        tokens, ids, stretches = tokens[kept], ids[kept], stretches[order][kept]
        if len(tokens):
            order = np.lexsort((ids, tokens))
            tokens, ids, stretches = tokens[order], ids[order], stretches[order]
            # copies of a set in several stretches bring an n-gram more than once; it counts for the set as often as in one stretch,
            # where only different n-grams of the set fall together
            other = np.append(True, (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1]))
            runs = np.flatnonzero(other | np.append(True, stretches[1:] != stretches[:-1]))
            times = np.diff(np.append(runs, len(tokens)))
            sums.append(_summed([(ids[other], np.maximum.reduceat(times, np.flatnonzero(other[runs])))]))
    own, total = _summed(sums)
    rows = [(r, own[mine].tobytes(), total[mine].tobytes()) for r in range(ranges) if (mine := own % np.uint64(ranges) == r).any()]
    kinds = (("r", pa.int32()), ("ids", pa.binary()), ("sums", pa.binary()))
    return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(zip(*rows, strict=True) if rows else [()] * 3, kinds, strict=True)})


def _summed(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    own, inverse = np.unique(np.concatenate([i for i, _ in sums]), return_inverse=True)
    return own, np.bincount(inverse, np.concatenate([c for _, c in sums]), len(own)).astype(np.int64)


def _all_shared(table: pa.Table) -> pa.Table:
    """The sums over all partitions, a row per set."""
    parts = zip(table.column("ids").to_pylist(), table.column("sums").to_pylist(), strict=True)
    own, total = _summed([(np.frombuffer(ids, np.uint64), np.frombuffer(sums, np.int64)) for ids, sums in parts])
    return pa.table({"id": pa.array(own.view(np.int64)), "shared": pa.array(total)})


ROWS = "hot boolean, doc_id long, key long, n long"


def _sets_and_hot(n: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's set key and size; and n-grams that occur in several documents of the task."""
        waiting, held = [], 0

        def hot() -> pa.RecordBatch:
            unique, counts = np.unique(np.concatenate(waiting), return_counts=True)
            many = counts >= HOT_IN_TASK
            rows = int(many.sum())
            return _batch(np.ones(rows, bool), pa.nulls(rows, pa.int64()), unique[many].view(np.int64), counts[many])

        for batch in batches:
            for s in W.word_slices(batch.column("text"), lower=True):
                text, tokens = grams(s, n)
                keys, sizes = set_keys(text, tokens, s.last - s.first)
                ids = batch.column("doc_id").slice(s.first, s.last - s.first).cast(pa.int64())
                yield _batch(np.zeros(len(keys), bool), ids, keys, sizes)
                waiting.append(tokens)
                held += len(tokens)
                if held >= HOT_TOKENS:
                    yield hot()
                    waiting, held = [], 0
        if held:
            yield hot()

    return found


def _batch(hot: np.ndarray, ids: pa.Array, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hot), ids, pa.array(keys), pa.array(n.astype(np.int64))], names=["hot", "doc_id", "key", "n"])


BEGINNINGS = "key long, n int, tokens array<long>"


def _beginnings(n: int, threshold: Threshold, most_small: int, hot: np.ndarray):
    """The first n-grams of each set: LEAD times as many as are entered in lists; small sets as a whole.

    The order is by hash, hot ones last: that bit comes first, so as signed numbers the hot ones are negative.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in W.word_slices(batch.column("text"), lower=True):
                text, tokens = grams(s, n)
                keys, sizes = set_keys(text, tokens, s.last - s.first)
                common = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens if len(hot) else np.zeros(len(tokens), bool)
                ordered = (tokens >> np.uint64(1)) | (common.astype(np.uint64) << np.uint64(63))
                order = np.lexsort((ordered, text))
                length = np.where(sizes <= most_small, sizes, np.minimum(sizes, np.ceil(LEAD * threshold.prefix(sizes)).astype(np.int64)))
                place = np.arange(len(text)) - (np.cumsum(sizes) - sizes)[text]
                taken = ordered[order[place < length[text]]].view(np.int64)
                offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(taken))],
                    names=["key", "n", "tokens"],
                )

    return found


SUBSETS = "token long, key long, role int"


def _subsets(threshold: Threshold, most_small: int):
    """The subsets of small sets. role 0: of the smaller of two sizes, 1: of the larger, 2: both are equal."""

    def of_set(own: list[int], key: int) -> Iterator[tuple[int, int, int]]:
        s = len(own)
        for t in threshold.partners(s):
            size = threshold.overlap(s, t)
            if size > min(s, t) or t > most_small:
                continue
            salt = W.mixed(np.array([min(s, t) * 1000 + max(s, t)], np.uint64))[0]
            for subset in combinations(own, size):
                with np.errstate(over="ignore"):
                    token = W.mixed(W.mixed(np.array(subset, np.int64).view(np.uint64)).sum(keepdims=True) + salt).view(np.int64)[0]
                yield int(token), key, 2 if s == t else int(s > t)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32())
        for batch in batches:
            rows = [row for own, key in zip(batch.column("tokens").to_pylist(), batch.column("key").to_pylist(), strict=True) for row in of_set(own, key)]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True) if rows else [()] * 3, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "key", "role"])

    return found


def _whole_sets(n: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in W.word_slices(batch.column("text"), lower=True):
                text, tokens = grams(s, n)
                keys, sizes = set_keys(text, tokens, s.last - s.first)
                ends = np.cumsum(sizes)
                tokens = [tokens[e - k : e].tobytes() for e, k in zip(ends, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(tokens, pa.binary())], names=["key", "tokens"])

    return found


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The intersection size of each two sets, by a scan of the lists of the tokens that two or more share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    unique, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    place = np.cumsum(shared) - 1
    kept = shared[inverse]
    owner, token = owner[kept], place[inverse[kept]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(shared.sum()), SCANNED):
        a, b = np.searchsorted(token, [first, first + SCANNED])
        lists = np.zeros((len(sets), SCANNED), np.float32)
        lists[owner[a:b], token[a:b] - first] = 1
        out += lists @ lists.T
    return out.astype(np.int64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links connect."""
    left, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        waiting = [root]
        while waiting:
            node = waiting.pop()
            new = np.flatnonzero(linked[node] & left)
            left[new] = False
            edges += [(node, k) for k in new.tolist()]
            waiting += new.tolist()
    return edges


GROUP = ("hub", "band", "i", "j")


def _grouped(work, names: tuple[str, ...], out: pa.Schema):
    """For mapInArrow over rows sorted by GROUP: work(group, columns) gives rows for each group of two or more."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own, made = None, [], []

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, field.type) for c, field in zip(zip(*made, strict=True), out, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=out)

        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in (*GROUP, *names)), strict=True):
                if row[:4] != group:
                    if len(own) > 1:
                        made += work(group, list(zip(*own, strict=True)))
                    group, own = row[:4], []
                own.append(row[4:])
            if made:
                yield batch_of()
                made = []
        if len(own) > 1:
            made += work(group, list(zip(*own, strict=True)))
        if made:
            yield batch_of()

    return found


def may_link(sizes: np.ndarray, beginnings: list[np.ndarray], threshold: Threshold) -> np.ndarray:
    """Which pairs the beginnings of their sets (in order) don't rule out."""
    need = -(-threshold.part * (sizes[:, None] + sizes[None, :]) // (threshold.part + threshold.whole))
    last = np.array([b[-1] for b in beginnings])
    seen = np.stack([np.searchsorted(b, last, "right") for b in beginnings])
    missing = seen - overlaps(beginnings)
    out = (missing <= sizes[:, None] - need) & (missing.T <= sizes[None, :] - need) & (need <= np.minimum(sizes[:, None], sizes[None, :]))
    np.fill_diagonal(out, False)
    return out


def _first_scan(threshold: Threshold):
    def work(group, columns):
        keys, sizes, tokens = columns
        left = may_link(np.array(sizes), [np.array(t, np.int64).view(np.uint64) for t in tokens], threshold).any(axis=1)
        return [(*group, key) for key, kept in zip(keys, left, strict=True) if kept]

    return work


def _second_scan(threshold: Threshold):
    def work(group, columns):
        keys, tokens = columns
        sets = [np.frombuffer(b, np.uint64) for b in tokens]
        sizes = np.array([len(s) for s in sets])
        both = overlaps(sets)
        links = threshold.whole * both >= threshold.part * (sizes[:, None] + sizes[None, :] - both)
        return [(keys[i], keys[j]) for i, j in forest(links)]

    return work


def _stored(df: DataFrame, purpose: str, schema: str) -> DataFrame:
    spark = df.sparkSession
    store = work_folder(spark, purpose)
    df.write.parquet(store)
    return spark.read.schema(schema).parquet(store)


def linked_classes(docs: DataFrame, n: int = 4, part: int = 85, whole: int = 100) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, key, n) and edges between classes (u, v) that connect what links connect."""
    threshold = Threshold(part, whole)
    spark = docs.sparkSession
    rows = _stored(docs.select("doc_id", "text").mapInArrow(_sets_and_hot(n), ROWS), "sets", ROWS)
    own = rows.where("not hot").select("doc_id", "key", "n")
    sizes = own.where(f"n <= {MOST_SMALL}").groupBy("n").agg(F.countDistinct("key").alias("sets"))
    most_small = boundary({row["n"]: row["sets"] for row in sizes.collect()}, threshold)
    # HOT n-grams at most, whatever the size of the corpus
    common = commonest(rows.where("hot").groupBy("key").agg(F.sum("n").alias("n")), HOT).select("key").toPandas()
    hot = np.sort(common["key"].to_numpy().astype(np.int64).view(np.uint64))
    # sets too few of whose n-grams occur elsewhere are done; one document stands for each class of the others
    tokens = own.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = max(0, int(np.ceil(np.log2(max(tokens, 1) / PARTITION_TOKENS))))
    ranges = max(1, (1 << bits) // 8)
    partial = docs.select("text").mapInArrow(_packed(n, bits), PACKED).groupBy("p").applyInArrow(lambda table: _shared(table, ranges), PARTIAL)
    shared = partial.groupBy("r").applyInArrow(_all_shared, SHARED)
    classes = own.where("n > 0").groupBy("key", "n").agg(F.min("doc_id").alias("d"))
    left = classes.join(shared, short_key(F.col("key")) == F.col("id")).where(whole * F.col("shared") >= part * F.col("n"))
    ids = _stored(left.select("d").distinct(), "ids", "d long")
    texts = _stored(docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("d")), "left_semi").select("text"), "texts", "text string")
    # one row per class; copies meet in their task before they are shuffled
    made = texts.mapInArrow(_beginnings(n, threshold, most_small, hot), BEGINNINGS).where("n > 0")
    begun = _stored(made.dropDuplicates(["key"]), "beginnings", BEGINNINGS)

    least = lambda role: F.min(F.when(F.col("role") == role, F.col("key")))
    few = begun.where(f"n <= {most_small}")
    listed = _stored(few.select("key", "tokens").mapInArrow(_subsets(threshold, most_small), SUBSETS), "subsets", SUBSETS)
    heads = listed.groupBy(F.col("token").alias("t")).agg(least(0).alias("lesser"), least(1).alias("greater"), least(2).alias("same"))
    other = F.when(F.col("role") == 0, F.col("greater")).when(F.col("role") == 1, F.col("lesser")).otherwise(F.col("same"))
    small_edges = listed.join(heads, F.col("token") == F.col("t")).select(F.col("key").alias("u"), other.alias("v")).where("u <> v").distinct()

    # list entries carry 40 bits of the n-gram: a list that two n-grams share by chance only means more to scan
    large = begun.where(F.col("n") >= threshold.partners(most_small + 1).start)
    prefix = F.expr(f"slice(tokens, 1, cast(n - ({part} * n + {whole - 1}) div {whole} + 1 as int))")
    lists = large.select("key", "n", F.explode(prefix).alias("token")).select((F.col("token") < 0).alias("hot"), F.shiftrightunsigned("token", 23).alias("token"), "key", "n")
    # an n-gram that is not hot is in less than HOT_IN_TASK sets of any stretch of a task, so its list is short
    of_token = Window.partitionBy("token")
    cold = lists.where("not hot").select("token", "key", "n").select("key", "n", F.min("key").over(of_token).alias("hub"), F.max("key").over(of_token).alias("last")).where("hub <> last")
    hot_lists = _stored(lists.where("hot").select("token", "key", "n").distinct(), "hot-lists", "token long, key long, n int")
    heads = hot_lists.groupBy(F.col("token").alias("t")).agg(F.min("key").alias("hub"), F.max("key").alias("last")).where("hub <> last")
    from_hot = hot_lists.join(heads, F.col("token") == F.col("t")).select("key", "n", "hub")
    # sets whose sizes may link are in one band or in two that follow each other: a guest of the band above its own meets that band's sets
    members = cold.select("key", "n", "hub").union(from_hot).distinct()
    ratio = float(np.log(whole / part))
    banded = members.select("*", F.floor(F.log(F.col("n")) / ratio + 1e-9).alias("own")).select(
        "hub", "key", F.explode(F.array(F.col("own"), F.col("own") + 1)).alias("band"), "own"
    )
    members = _stored(banded, "members", "hub long, key long, band long, own long")
    blocks = (
        members.groupBy(F.col("hub").alias("h"), F.col("band").alias("x"))
        .agg(F.count("*").alias("all"), F.count(F.when(F.col("band") == F.col("own"), 1)).alias("hosts"))
        .where("hosts > 0 and all > 1")
        .select("h", "x", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"))
    )
    numbers = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = (
        members.join(blocks, (F.col("hub") == F.col("h")) & (F.col("band") == F.col("x")))
        .withColumn("b", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .select("hub", "band", "key", "b", F.explode(numbers).alias("c"))
        .select("hub", "band", F.least("b", "c").alias("i"), F.greatest("b", "c").alias("j"), "key")
    )
    group = "hub long, band long, i int, j int"
    dealt = _stored(dealt, "dealt", f"{group}, key long")
    firsts = large.join(dealt.select(F.col("key").alias("k")).distinct(), F.col("key") == F.col("k"), "left_semi")
    first = dealt.join(firsts, "key").select(*GROUP, "key", "n", "tokens").repartition(*GROUP).sortWithinPartitions(*GROUP)
    schema = pa.schema([("hub", pa.int64()), ("band", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("key", pa.int64())])
    left = _stored(first.mapInArrow(_grouped(_first_scan(threshold), ("key", "n", "tokens"), schema), f"{group}, key long"), "left", f"{group}, key long")

    involved = left.select(F.col("key").alias("k")).distinct()
    sets = texts.mapInArrow(_whole_sets(n), "key long, tokens binary").join(involved, F.col("key") == F.col("k"), "left_semi").dropDuplicates(["key"])
    second = left.join(sets, "key").select(*GROUP, "key", "tokens").repartition(*GROUP).sortWithinPartitions(*GROUP)
    pair = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    linked = second.mapInArrow(_grouped(_second_scan(threshold), ("key", "tokens"), pair), "u long, v long")
    return own, _stored(linked.union(small_edges), "links", "u long, v long")


def _rooted(docs: DataFrame, n: int, part: int, whole: int) -> DataFrame:
    own, edges = linked_classes(docs, n, part, whole)
    roots = components(edges)
    return own.join(roots, F.col("key") == F.col("node"), "left").select("doc_id", "key", "n", F.coalesce("root", "key").alias("root"))


def grouped(docs: DataFrame, n: int = 4, part: int = 85, whole: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    rooted = _rooted(docs, n, part, whole)
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("doc_id").alias("least"))
    return rooted.join(least, F.col("root") == F.col("r")).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def first_of_groups(docs: DataFrame, n: int = 4, part: int = 85, whole: int = 100) -> DataFrame:
    """The documents, with one of each group of linked ones: that of the smallest doc_id (a null is the largest). Those without words stay."""
    thin = "doc_id long, key long, root long"
    rooted = _stored(_rooted(docs, n, part, whole).where("n > 0").select("doc_id", "key", "root"), "rooted", thin)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    first = rooted.groupBy(F.col("root").alias("r")).agg(F.min(place).alias("first"))
    marked = rooted.join(first, F.col("root") == F.col("r")).select("doc_id", "key", (place == F.col("first")).alias("stays"))
    marked = _stored(marked.groupBy("doc_id", "key", "stays").agg(F.count("*").alias("rows")), "marked", "doc_id long, key long, stays boolean, rows long")
    named = plain(docs, "doc_id", "text")
    names = named.columns

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.zeros(0, np.int64)]
            for s in W.word_slices(batch.column("text"), lower=True):
                keys.append(set_keys(*grams(s, n), s.last - s.first)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(keys))], names=[*names, "_key"])

    rows = named.mapInArrow(keyed, StructType([*named.schema.fields, StructField("_key", LongType())]))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k"))
    later = marked.where("not stays").select(F.col("doc_id").alias("_id"), F.col("key").alias("_k"))
    alone = rows.join(later, same, "left_anti")
    repeated = marked.where("stays and rows > 1").select(F.col("doc_id").alias("_id"), F.col("key").alias("_k"))
    if repeated.isEmpty():
        return alone.select(names).toDF(*docs.columns)
    again = alone.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "_key"])
    return alone.join(repeated, same, "left_anti").union(again).select(names).toDF(*docs.columns)
