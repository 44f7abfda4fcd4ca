"""Scoring texts by a hidden Markov language model over word classes.

A text is its words (A to Z in lower case) and one end token. The commonest words (``own_classes``) are a class each; the others
share classes by length, digits and a mark at the end; the end is a class of its own. Hidden states emit classes and a class emits its
words by their counts with one added (one more count stands for all words not met), so the probabilities of all texts sum to one.

Baum-Welch learns the states, in its incremental form: texts are encoded as classes once, in ``BLOCKS`` blocks. Each task runs the forward and backward
recursions over its texts, longest first, and adds up the expected counts of states, moves and emissions; Spark adds those over the tasks, in packed ranges of
cells. The model is renewed after each block, from the last counts of every block. Passes over all blocks go on until one gains less than ``TOLERANCE``
of log10 likelihood per token; the likelihood rises with every renewal, so they end. They start from a model that keeps its states from word to word, which has
converged in the same way on about ``START_TOKENS`` tokens (all, where there are fewer). States and classes grow with the distinct words, up to ``CELLS`` emissions in all. The exact log likelihood comes from the
scaled forward recursion over the whole text. Word counts cover all training documents. The commonest words, ``KNOWN`` at most, are known to
every task, a table of bounded size; the others meet their counts in a join on the word, pre-aggregated to a row per text and word, and their
sums go back to the text, not to each of its copies.

Words and texts are told apart by 64-bit hashes. A null text is an empty one: one end token. A null doc_id counts as a training row. Repeated
rows are scored alike, and count as often as they occur in training. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.samples import commonest
from quotelake.session import work_folder

STATES = 5  # at least
CLASSES = 1024  # at least
CELLS = 1 << 18
TOLERANCE = 1e-3
START_TOKENS = 1_000_000
STAYS = 0.9
KNOWN = 1 << 16
KINDS = 64
BLOCKS = 4
GROUP_CELLS = 4_800_000
SORTED_TOKENS = 4_000_000
RANGE_CELLS = 4096
SALTS = 64
MOVES_AT_ONCE = 1 << 13
EMITS_AT_ONCE = 1 << 14  # what is held of these stays in a core's cache
COUNTED_WORDS = 2_000_000
PLACE_BITS = 18
_PLACE_SHIFT = np.uint64(64 - PLACE_BITS)

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LAST_MARK = np.zeros(256, np.int64)
_LAST_MARK[list(b".,;:!?#*$%&|<>)\"'")] = 1


def kinds(s: W.Slice) -> np.ndarray:
    """The shared class of each word: length (up to 15 bytes), a digit in it, a mark at its end."""
    if not len(s.starts):
        return np.zeros(0, np.int64)
    digit = np.zeros(len(s.starts), np.int64)
    digit[np.searchsorted(s.starts, np.flatnonzero(_DIGIT[s.data]), "right") - 1] = 1
    return np.minimum(s.ends - s.starts, 15) + 16 * digit + 32 * _LAST_MARK[s.data[s.ends - 1]]


class Places(NamedTuple):
    """Where the words that begin with the same PLACE_BITS bits lie among words in order. Hashes are spread evenly, so few share them."""

    first: np.ndarray
    most: int  # words with the same bits


def places_of(words: np.ndarray) -> Places:
    sizes = np.bincount((words >> _PLACE_SHIFT).astype(np.int64), minlength=1 << PLACE_BITS)
    return Places((np.cumsum(sizes) - sizes).astype(np.int32), int(sizes.max()))


class Vocabulary(NamedTuple):
    """The commonest words in order of their hashes, and totals of all words."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray  # -1: the shared class of its kind
    kind_tokens: np.ndarray
    kind_words: np.ndarray
    documents: int
    tokens: int  # with the ends
    distinct: int
    own: int  # words with a class of their own; the classes of the kinds and of the end follow
    places: Places

    @property
    def size(self) -> int:
        return self.own + KINDS + 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The places of words, -1 for others."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        last = len(self.words) - 1
        at = np.minimum(self.places.first[(hashes >> _PLACE_SHIFT).astype(np.int64)], last)
        found = np.where(self.words[at] == hashes, at, -1).astype(np.int64)
        for k in range(1, self.places.most):
            missing = np.flatnonzero(found < 0)
            later = np.minimum(at[missing] + k, last)
            same = self.words[later] == hashes[missing]
            found[missing[same]] = later[same]
        return found


def _held_out(share: int, remainder: int) -> Column:
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % share == remainder, F.lit(False))


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, kind, n = (np.concatenate(p) for p in zip(*parts, strict=True))
    coded = pa.array(words).dictionary_encode()  # by a hash table, so nothing is put in order
    unique, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    kind_of = np.empty(len(unique), kind.dtype)
    kind_of[which] = kind
    return unique, kind_of, np.bincount(which, n, len(unique)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of a task's texts with their counts, added up before anything is shuffled."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def out() -> pa.RecordBatch:
        word, kind, n = _merged(parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), pa.array(kind.astype(np.int32)), pa.array(n)], names=["word", "kind", "n"]
        )

    for batch in batches:
        for s in W.word_slices(batch.column("text"), lower=True, slice_bytes=W.SMALL_SLICE_BYTES):
            if len(s.hashes):
                parts.append(_merged([(s.hashes, kinds(s), np.ones(len(s.hashes)))]))
                held += len(parts[-1][0])
                if held > COUNTED_WORDS:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if held > COUNTED_WORDS // 2:
                        yield out()
                        parts, held = [], 0
    if parts:
        yield out()


def word_counts(training: DataFrame) -> DataFrame:
    """word, kind, n: every distinct word of the texts. Stored once."""
    spark = training.sparkSession
    store = work_folder(spark, "words")
    counted = training.select("text").mapInArrow(_counted, "word long, kind int, n long")
    counted.groupBy("word").agg(F.max("kind").alias("kind"), F.sum("n").alias("n")).write.parquet(store)
    return spark.read.schema("word long, kind int, n long").parquet(store)


def states_of(distinct: int) -> int:
    return max(STATES, round(2 / 3 * np.log2(max(distinct, 1))))


def classes_of(distinct: int, known: int = KNOWN) -> int:
    """How many words have a class of their own: one in 32 of the distinct words, within CELLS emissions of all states."""
    return min(known, max(CLASSES, distinct // 32), max(CLASSES, CELLS // states_of(distinct) - KINDS - 1))


def vocabulary(counts: DataFrame, documents: int, known: int = KNOWN, own_classes: int | None = None) -> Vocabulary:
    top = commonest(counts, known).toPandas().sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    word = top["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(word)
    tokens, distinct = np.zeros(KINDS, np.int64), np.zeros(KINDS, np.int64)
    for row in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tokens[row["kind"]], distinct[row["kind"]] = row["n"], row["words"]
    all_tokens, all_words = int(tokens.sum()), int(distinct.sum())
    if own_classes is None:
        own_classes = classes_of(all_words, known)
    classes = np.where(np.arange(len(word)) < own_classes, np.arange(len(word)), -1)
    own = classes >= 0
    if len(word):
        tokens -= np.bincount(top["kind"][own], top["n"][own], KINDS).astype(np.int64)
        distinct -= np.bincount(top["kind"][own], minlength=KINDS)
    return Vocabulary(
        word[order],
        top["n"].to_numpy().astype(np.int64)[order],
        classes[order],
        tokens,
        distinct,
        documents,
        all_tokens + documents,
        all_words + (documents > 0),
        own_classes,
        places_of(word[order]),
    )


class Model(NamedTuple):
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x classes


def initial(v: Vocabulary, states: int = STATES, seed: int = 7) -> Model:
    random = np.random.default_rng(seed)
    share = np.full(v.size, 1.0)
    share[v.classes[v.classes >= 0]] += v.counts[v.classes >= 0]
    share[v.own : v.own + KINDS] += v.kind_tokens
    share[-1] += v.documents
    # far from equal states, between which the likelihood hardly changes for many rounds
    emit = share * (random.gamma(0.5, 2.0, (states, v.size)) + 0.05)
    move = random.uniform(0.5, 1.5, (states, states))
    move = STAYS * np.eye(states) + (1 - STAYS) * move / move.sum(axis=1, keepdims=True)
    start = random.uniform(0.5, 1.5, states)
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


class Lattice(NamedTuple):
    """Class sequences of several texts, longest first, laid out by time step: step t holds token t of all texts that have one."""

    classes: np.ndarray
    starts: np.ndarray  # of the steps
    active: np.ndarray  # texts at each step
    order: np.ndarray  # the texts by rank
    rank: np.ndarray  # of each token


def lattice(classes: np.ndarray, lengths: np.ndarray) -> Lattice:
    order = np.argsort(-lengths, kind="stable")
    rank_of = np.empty(len(order), np.int64)
    rank_of[order] = np.arange(len(order))
    ends = np.cumsum(lengths)
    position = np.arange(int(lengths.sum())) - np.repeat(ends - lengths, lengths)
    steps = int(lengths.max())
    active = np.bincount(position, minlength=steps)
    starts = np.cumsum(active) - active
    rank = np.repeat(rank_of, lengths)
    at = starts[position] + rank
    laid, ranks = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    laid[at], ranks[at] = classes, rank
    return Lattice(laid, starts, active, order, ranks)


class Room:
    """Arrays that lattice after lattice uses again: to get new ones of this size takes about as long as to fill them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def array(self, name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or self.held[name].size < size or self.held[name].dtype != dtype:
            self.held[name] = np.empty(size, dtype)
        return self.held[name][:size].reshape(shape)


def forward(model: Model, x: Lattice, room: Room) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward probabilities, their scales, and the emissions of each token: in the room, so until its next use."""
    shape, kind = (len(x.classes), len(model.start)), model.emit.dtype
    emitted, alpha, scale = room.array("emitted", shape, kind), room.array("alpha", shape, kind), room.array("scale", shape[:1], kind)
    np.take(np.ascontiguousarray(model.emit.T), x.classes, axis=0, out=emitted, mode="clip")  # else numpy fills a copy first
    ones = np.ones(len(model.start), emitted.dtype)
    # a long text has many steps of few texts, so each step is four calls that write where their result stays
    before = None
    for start, n in zip(x.starts.tolist(), x.active.tolist(), strict=True):
        now, total = alpha[start : start + n], scale[start : start + n]
        if before is None:
            np.multiply(model.start, emitted[:n], out=now)
        else:
            np.matmul(before[:n], model.move, out=now)
            np.multiply(now, emitted[start : start + n], out=now)
        np.matmul(now, ones, out=total)
        np.divide(now, total[:, None], out=now)
        before = now
    return alpha, scale, emitted


def log10_likelihood(model: Model, x: Lattice, room: Room | None = None) -> np.ndarray:
    """Of each text, in the order given to ``lattice``."""
    _, scale, _ = forward(model, x, room or Room())
    out = np.empty(len(x.order))
    out[x.order] = np.bincount(x.rank, np.log10(scale), len(x.order))
    return out


def expected(model: Model, x: Lattice) -> Model:
    """Baum-Welch's expected counts over the texts of a lattice."""
    return expected_and_likelihood(model, x)[0]


def expected_and_likelihood(model: Model, x: Lattice, room: Room | None = None) -> tuple[Model, float]:
    """The expected counts, and the log10 likelihood of all texts."""
    room = room or Room()
    alpha, scale, emitted = forward(model, x, room)
    emitted /= scale[:, None]
    states = len(model.start)
    back = model.move.T.copy()
    beta = room.array("beta", emitted.shape, emitted.dtype)
    beta.fill(1.0)
    starts, active = x.starts.tolist(), x.active.tolist()
    for t in range(len(starts) - 1, 0, -1):
        start, n, before = starts[t], active[t], starts[t - 1]
        ahead = emitted[start : start + n]
        np.multiply(ahead, beta[start : start + n], out=ahead)
        np.matmul(ahead, back, out=beta[before : before + n])
    # a token follows the one that lies as many places before as its previous step has texts
    moves = np.zeros((states, states))
    follows = np.arange(active[0], len(x.classes)) - np.repeat(x.active[:-1], x.active[1:])
    for at in range(0, len(follows), MOVES_AT_ONCE):
        part = follows[at : at + MOVES_AT_ONCE]
        moves += alpha.take(part, axis=0).T @ emitted[active[0] + at : active[0] + at + len(part)]
    emits, weights = np.zeros((states, model.emit.shape[1])), np.empty((states, EMITS_AT_ONCE))
    for at in range(0, len(alpha), EMITS_AT_ONCE):
        part = slice(at, min(at + EMITS_AT_ONCE, len(alpha)))
        now = weights[:, : part.stop - at]
        np.multiply(alpha[part].T, beta[part].T, out=now)
        for k in range(states):
            emits[k] += np.bincount(x.classes[part], now[k], emits.shape[1])
    first = alpha[: active[0]] * beta[: active[0]]
    return Model(first.sum(axis=0), moves * model.move, emits), float(np.log10(scale, dtype=np.float64).sum())


def updated(counts: Model) -> Model:
    emit = counts.emit + 1e-2
    move, start = counts.move + 1e-2, counts.start + 1e-2
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _classes(s: W.Slice, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens with the ends, lengths of the texts, and for the words: their places in the vocabulary and kinds."""
    place, kind = v.find(s.hashes), kinds(s)
    own = np.where(place >= 0, v.classes[place], -1) if len(v.words) else np.full(len(place), -1)
    classes = np.where(own >= 0, own, v.own + kind)
    bounds = s.bounds()
    return np.insert(classes, bounds[1:], v.own + KINDS), np.diff(bounds) + 1, place, kind


def by_length(classes: np.ndarray, lengths: np.ndarray, states: int) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Lattices of about GROUP_CELLS tokens times states (or one text, if it has more), of texts of like lengths, with the places of
    the texts. A lattice takes a step per token of its longest text, so long texts stay among themselves."""
    order = np.argsort(-lengths, kind="stable")
    begins = np.cumsum(lengths) - lengths
    group = (np.cumsum(lengths[order]) - lengths[order]) * states // GROUP_CELLS
    for own in np.split(order, np.flatnonzero(np.diff(group)) + 1) if len(order) else []:
        n = lengths[own]
        tokens = np.repeat(begins[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        yield own, lattice(classes[tokens].astype(np.int64), n)


SEQUENCES = "block int, classes binary, lengths binary, keys binary"


def encoded(training: DataFrame, v: Vocabulary) -> DataFrame:
    """The class sequences of all texts, a row per slice of texts, stored by block: every pass reads these and no text again."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(v)  # KNOWN words
    kind = np.dtype("<u2" if v.size < 1 << 16 else "<u4")

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            for s in W.word_slices(batch.column("text"), lower=True):
                classes, lengths, _, _ = _classes(s, v)
                keys = W.mixed(W.span_hashes(s.data, s.offsets[:-1], s.offsets[1:]))
                home = (keys % np.uint64(BLOCKS)).astype(np.int64)
                own = np.repeat(home, lengths)
                for b in range(BLOCKS):
                    if (home == b).any():
                        parts = [classes[own == b].astype(kind), lengths[home == b].astype("<i4"), keys[home == b]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([b], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]], names=["block", "classes", "lengths", "keys"]
                        )

    store = work_folder(spark, "sequences")
    training.select("text").mapInArrow(sequences, SEQUENCES).write.partitionBy("block").parquet(store)
    return spark.read.schema(SEQUENCES).parquet(store)


def _row(batch: pa.RecordBatch, row: int, wide: bool) -> list[np.ndarray]:
    kinds_of = (("classes", "<u4" if wide else "<u2"), ("lengths", "<i4"), ("keys", "<u8"))
    return [np.frombuffer(batch.column(c)[row].as_buffer(), kind) for c, kind in kinds_of]


def _sequences(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Classes and lengths of about SORTED_TOKENS tokens at once."""
    parts, held = [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            classes, lengths, _ = _row(batch, row, wide)
            if len(lengths):
                parts.append((classes, lengths.astype(np.int64)))
                held += len(classes)
            if held >= SORTED_TOKENS:
                yield tuple(np.concatenate(p) for p in zip(*parts, strict=True))
                parts, held = [], 0
    if parts:
        yield tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def some_sequences(sequences: DataFrame, v: Vocabulary, tokens: int) -> DataFrame:
    """The sequences of about so many tokens (all, where there are fewer), of the texts with the lowest keys. Stored."""
    share, wide = min(1 << 32, int(tokens / max(v.tokens, 1) * (1 << 32))), v.size >= 1 << 16

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                classes, lengths, keys = _row(batch, row, wide)
                few = (keys >> np.uint64(32)) < np.uint64(share)
                parts = [classes[np.repeat(few, lengths)], lengths[few], keys[few]]
                if len(parts[1]):
                    columns = [pa.array([0], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts]]
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "classes", "lengths", "keys"])

    spark = sequences.sparkSession
    store = work_folder(spark, "start")
    few = sequences.select("block", "classes", "lengths", "keys").mapInArrow(chosen, SEQUENCES)
    few.repartition(12).write.parquet(store)  # some megabytes
    return spark.read.schema(SEQUENCES).parquet(store)


def expected_over(sequences: DataFrame, v: Vocabulary, model: Model) -> tuple[Model, float, float]:
    """The expected counts over all texts, their log10 likelihood and their tokens. A range of cells is a row of a task; rows of many tasks are added by salt first."""
    spark = sequences.sparkSession
    shared = spark.sparkContext.broadcast(Model(*[part.astype(np.float32) for part in model]))  # CELLS emissions at most
    wide = v.size >= 1 << 16

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cells, room = shared.value, None, Room()
        for classes, lengths in _sequences(batches, wide):
            for _, x in by_length(classes, lengths, len(model.start)):
                found, likelihood = expected_and_likelihood(model, x, room)
                flat = np.concatenate([*[part.ravel() for part in found], [likelihood, len(x.classes)]])
                cells = flat if cells is None else cells + flat
        if cells is not None:
            salt = TaskContext.get().partitionId() % SALTS
            ranges = [cells[at : at + RANGE_CELLS] for at in range(0, len(cells), RANGE_CELLS)]
            columns = [np.arange(len(ranges)), np.full(len(ranges), salt)]
            packed = pa.array([r.astype("<f8").tobytes() for r in ranges], pa.binary())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in columns], packed], names=["range", "salt", "cells"])

    def added(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(c.as_buffer(), "<f8") for c in table.column("cells")], axis=0)
        return table.slice(0, 1).set_column(table.schema.get_field_index("cells"), "cells", pa.array([total.tobytes()], pa.binary()))

    schema = "range int, salt int, cells binary"
    rows = sequences.select("classes", "lengths", "keys").mapInArrow(counted, schema)
    if sequences.rdd.getNumPartitions() > SALTS:  # with fewer tasks, a range and salt has one row
        rows = rows.groupBy("range", "salt").applyInArrow(added, schema)
    whole = rows.groupBy("range").applyInArrow(added, schema)
    # as many cells as the model has, and two
    found = sorted((r["range"], bytes(r["cells"])) for r in whole.collect())
    shared.destroy()
    flat = np.frombuffer(b"".join(cells for _, cells in found), "<f8") if found else np.zeros(sum(part.size for part in model) + 2)
    parts = np.split(flat[:-2], np.cumsum([part.size for part in model])[:-1])
    return Model(*[part.reshape(old.shape) for part, old in zip(parts, model, strict=True)]), float(flat[-2]), float(flat[-1])


def one_round(sequences: DataFrame, v: Vocabulary, model: Model) -> tuple[Model, float]:
    """The model after one pass over all texts, and the log10 likelihood per token before it."""
    counts, likelihood, tokens = expected_over(sequences, v, model)
    return updated(counts), likelihood / max(tokens, 1.0)


def _enough(likelihoods: list[float], rounds: int | None) -> bool:
    gains = len(likelihoods) < 2 or likelihoods[-1] - likelihoods[-2] >= TOLERANCE
    return not gains or (rounds is not None and len(likelihoods) >= rounds)


def converged(sequences: DataFrame, v: Vocabulary, model: Model, rounds: int | None = None) -> tuple[Model, list[float]]:
    """Passes until one gains less than TOLERANCE (or as many as given); the likelihood per token in each."""
    likelihoods: list[float] = []
    held: dict[int, Model] = {}  # each block's counts, as large as the model
    while not _enough(likelihoods, rounds):
        total = [0.0, 0.0]
        for block in range(BLOCKS):
            held[block], likelihood, tokens = expected_over(sequences.where(F.col("block") == block), v, model)
            total = [total[0] + likelihood, total[1] + tokens]
            model = updated(Model(*[np.sum(parts, axis=0) for parts in zip(*held.values(), strict=True)]))
        likelihoods.append(total[0] / max(total[1], 1.0))
    return model, likelihoods


def started(sequences: DataFrame, v: Vocabulary, model: Model) -> Model:
    """The model that has converged on about START_TOKENS tokens, chosen by a hash of their texts."""
    few, likelihoods = some_sequences(sequences, v, START_TOKENS), []
    while not _enough(likelihoods, None):
        model, likelihood = one_round(few, v, model)
        likelihoods.append(likelihood)
    return model


def trained(sequences: DataFrame, v: Vocabulary, rounds: int | None = None, states: int | None = None) -> tuple[Model, list[float]]:
    return converged(sequences, v, started(sequences, v, initial(v, states or states_of(v.distinct))), rounds)


TEXTS = "doc_id long, held_out boolean, key long, n_tokens long, known long, sum_log double, class_log double, chain_log double"


def scored(
    docs: DataFrame,
    share: int = 7,
    remainder: int = 2,
    rounds: int | None = None,
    states: int | None = None,
    known: int = KNOWN,
    own_classes: int | None = None,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    spark = docs.sparkSession
    marked = docs.select("doc_id", "text", _held_out(share, remainder).alias("held_out"))
    training = marked.where("not held_out")
    counts = word_counts(training)
    v = vocabulary(counts, training.count(), known, own_classes)
    model, _ = trained(encoded(training, v), v, rounds, states)
    shared = spark.sparkContext.broadcast((model, v))  # CELLS emissions at most, and KNOWN words

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, v = shared.value
        log_counts = np.log10(v.counts + 1.0)
        log_kinds = np.log10(v.kind_tokens + v.kind_words + 1.0)
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(6)]
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            for s in W.word_slices(batch.column("text"), lower=True, slice_bytes=W.SMALL_SLICE_BYTES):
                classes, lengths, place, kind = _classes(s, v)
                n, known = s.last - s.first, place >= 0
                logs = np.where(known, log_counts[place], 0.0) if len(v.words) else np.zeros(len(place))
                own = known & (v.classes[place] >= 0) if len(v.words) else known
                # within a class of one word, the word is certain
                within = np.where(own, 0.0, logs - log_kinds[kind])
                parts[0].append(W.span_hashes(s.data, s.offsets[:-1], s.offsets[1:]).view(np.int64))
                parts[1].append(lengths)
                parts[2].append(np.bincount(s.text[known], minlength=n) + (v.documents > 0))
                parts[3].append(np.bincount(s.text, logs, n) + np.log10(v.documents + 1.0))
                parts[4].append(np.bincount(s.text, within, n))
                waiting.append((classes, lengths))
                if sum(len(c) for c, _ in waiting) >= SORTED_TOKENS:
                    parts[5].append(_chain(model, waiting))
                    waiting = []
            if waiting:
                parts[5].append(_chain(model, waiting))
            columns = [pa.array(np.concatenate(p) if p else np.zeros(0)) for p in parts]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), *[c.cast(t) for c, t in zip(columns, types, strict=True)]],
                names=[part.split()[0] for part in TEXTS.split(", ")],
            )

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's words outside the known ones: (key of the text, word, times)."""
        _, v = shared.value
        for batch in batches:
            for s in W.word_slices(batch.column("text"), lower=True, slice_bytes=W.SMALL_SLICE_BYTES):
                others = np.flatnonzero(v.find(s.hashes) < 0)
                if not len(others):
                    continue
                keys = W.span_hashes(s.data, s.offsets[:-1], s.offsets[1:])
                text, word = s.text[others], s.hashes[others]
                order = np.lexsort((word, text))
                text, word = text[order], word[order]
                first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (word[1:] != word[:-1])))
                times = np.diff(np.append(first, len(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[text[first]].view(np.int64)), pa.array(word[first].view(np.int64)), pa.array(times.astype(np.int32))],
                    names=["key", "word", "times"],
                )

    store = work_folder(spark, "scored")
    marked.mapInArrow(of_texts, TEXTS).write.parquet(store)
    texts = spark.read.schema(TEXTS).parquet(store)
    copies = texts.groupBy("key").agg(F.count("*").alias("copies"))
    found = (
        docs.select("text")
        .mapInArrow(rare, "key long, word long, times int")
        .join(counts.select("word", F.log10(F.col("n") + 1).alias("log_count")), "word")
        .groupBy("key")
        .agg(F.sum(F.col("times") * F.col("log_count")).alias("rare_log"), F.sum("times").alias("rare_known"))
        .join(copies, "key")
        # a text's words were met once for each of its copies
        .select("key", (F.col("rare_log") / F.col("copies")).alias("rare_log"), F.expr("rare_known div copies").alias("rare_known"))
    )
    rare_log, rare_known = F.coalesce("rare_log", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    level = float(np.log10(v.tokens + v.distinct + 1))
    return texts.join(found, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + rare_known).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("sum_log") + rare_log - F.col("n_tokens") * F.lit(level)).alias("base_score"),
        (F.col("chain_log") + F.col("class_log") + rare_log).alias("score"),
    )


def _chain(model: Model, waiting: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    classes, lengths = (np.concatenate(parts) for parts in zip(*waiting, strict=True))
    out, room = np.empty(len(lengths)), Room()
    for own, x in by_length(classes, lengths, len(model.start)):
        out[own] = log10_likelihood(model, x, room)
    return out
