"""Packing token sequences into bins by minimum bin slack.

For each bin, a subset-sum dynamic program over the lengths at hand (one bit per sum) finds the fullest combination that fits; it is
taken out, and so on. Among equally full combinations, the one with the longest pieces wins, which leaves the short ones
to fill later bins. That is done with any combination and with one around the longest piece at hand, each with several allowed slacks (a bin
that misses the fullest sum by no more than the slack takes the longest pieces instead); the plan with the fewest bins is used. Lengths are at most the capacity, so only a count per length meets in one place; a combination is taken out as
often as the counts allow at once, which uses up a length each time. So there are about as many patterns as lengths, at any size of the corpus.

Pieces are then numbered within their length (by cells that a hash fills evenly, since one length may hold most pieces), and a piece's number
says which pattern, which bin of it and which place it gets.

A null text is an empty document of one token (the end). Copies and repeated doc_ids are packed as separate rows. Extra
columns are ignored; an empty table gives an empty result. Documents longer than a bin are cut; the first piece is the shorter one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.session import work_folder

CAPACITY = 1024
SLACKS = (0, 2, 8)
END = 2
CELLS = 4096
KNOWN_PARTS = 1_500_000

# The UTF-8 bytes of white space beyond ASCII (Unicode's property White_Space).
_FAR_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_ALNUM = np.zeros(256, bool)
_ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _tokenizer(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(name))


def _letter_table() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, the others from code point 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class PartIds:
    """The ids of text parts, kept by the hash of their bytes from one slice to the next.

    A text is cut before white space that follows other characters, and between an ASCII letter or digit and an ASCII mark; byte-level
    vocabularies never join characters there. Each part goes through the tokenizer once; texts are put together from the known parts.
    Texts with far white space or with the string of an added token (which the tokenizer turns into its one id) go through it whole.
    """

    def __init__(self, name: str, most: int = KNOWN_PARTS) -> None:
        self.tokenizer = _tokenizer(name)
        added = [re.escape(token.content.encode()) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile(b"|".join([_FAR_SPACE.pattern, *added]))
        self.model, self.letters, self.most = self.tokenizer.model, _letter_table(), most
        self.reset()

    def reset(self) -> None:
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.counts, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, part: bytes) -> list[int]:
        text = part.decode()
        word = text[1:] if text[0] == " " else text
        if word.isalpha() and max(word) < "\u0250":  # one word is one run of merges
            return [token.id for token in self.model.tokenize(part.decode("latin-1").translate(self.letters))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        found = [self.encode(part) for part in parts]
        counts = np.array([len(ids) for ids in found], np.int64)
        self.starts = np.append(self.starts, len(self.pool) + np.cumsum(counts) - counts)
        at = np.searchsorted(self.hashes, hashes)
        self.places = np.insert(self.places, at, len(self.counts) + np.arange(len(counts)))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.counts = np.append(self.counts, counts)
        self.pool = np.append(self.pool, np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum())))

    def of(self, s: W.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice and where each text's begin and end among them."""
        word = ~W._SPACES[s.data]
        edge = np.zeros(len(s.data) + 1, bool)
        edge[s.offsets] = True
        edge[1:-1] |= (word[:-1] & ~word[1:]) | (_ALNUM[s.data[:-1]] & _MARK[s.data[1:]])
        edges = np.flatnonzero(edge)
        starts, ends = edges[:-1], edges[1:]
        hashes = W.span_hashes(s.data, starts, ends)
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(unique) > self.most:
            self.reset()
        at = np.searchsorted(self.hashes, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != unique[inside]
        if new.any():
            raw = s.data.tobytes()
            self.learn(unique[new], [raw[starts[k] : ends[k]] for k in first[new]])
        place = self.places[np.searchsorted(self.hashes, unique)][inverse]
        counts = self.counts[place]
        before = np.concatenate(([0], np.cumsum(counts)))
        ids = self.pool[np.repeat(self.starts[place] - before[:-1], counts) + np.arange(before[-1])]
        return ids, before[np.searchsorted(edges, s.offsets)]

    def texts(self, column: pa.Array, end: int) -> Iterator[np.ndarray]:
        """The ids of each row's text, with the id ``end`` after them."""
        last = np.array([end], np.uint32)
        for s in W.word_slices(column):
            ids, bounds = self.of(s)
            far = bool(self.whole.search(s.data.tobytes()))
            for k in range(s.last - s.first):
                own = ids[bounds[k] : bounds[k + 1]]
                if far and self.whole.search(raw := s.data[s.offsets[k] : s.offsets[k + 1]].tobytes()):
                    own = np.array(self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids, np.uint32)
                yield np.concatenate((own, last))


@cache
def _parts(name: str) -> PartIds:
    """One for each Python worker, which keeps it for its next tasks."""
    return PartIds(name)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(start, capacity) for start in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _parts(tokenizer)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            rows = [
                (doc_id, k, start, length, zlib.crc32(ids[start : start + length].astype("<u4").tobytes()))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), known.texts(batch.column("text"), end), strict=True)
                for k, (start, length) in enumerate(cut(len(ids), capacity))
            ]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True) if rows else [()] * 5, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(tokenized, PIECES)


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Combinations of lengths with the number of bins of each: (bins, {length: pieces per bin})."""
    plans = [_emptied(counts, capacity, partial(pick, slack=slack)) for slack in SLACKS for pick in (_fullest, _around_longest)]
    return min(plans, key=lambda found: sum(bins for bins, _ in found))


def _emptied(counts: dict[int, int], capacity: int, pick: Callable[[dict[int, int], int], dict[int, int]]) -> list[tuple[int, dict[int, int]]]:
    left = {length: n for length, n in sorted(counts.items(), reverse=True) if n > 0}
    found = []
    while left:
        combination = pick(left, capacity)
        bins = min(left[length] // n for length, n in combination.items())
        for length, n in combination.items():
            left[length] -= bins * n
            if not left[length]:
                del left[length]
        found.append((bins, combination))
    return found


def _fullest(left: dict[int, int], capacity: int, slack: int = 0) -> dict[int, int]:
    """The combination of lengths with the greatest sum up to capacity, or with at most ``slack`` less and longer pieces. left: longest first."""
    mask = (1 << (capacity + 1)) - 1
    lengths = list(left)
    # reach[k]: the sums that lengths k and on can make; short lengths are added first, so that long ones are picked first
    reach = [1] * (len(lengths) + 1)
    for k in range(len(lengths) - 1, -1, -1):
        sums, copies, step = reach[k + 1], min(left[lengths[k]], capacity // lengths[k]), 1
        while copies > 0:
            step = min(step, copies)
            sums |= sums << (lengths[k] * step) & mask
            copies -= step
            step *= 2
        reach[k] = sums
    top = reach[0].bit_length() - 1
    least = max(top - slack, 0)
    # wanted: the sums still to be made by the lengths to come
    wanted, room, taken = reach[0] >> least << least, top, {}
    for k, length in enumerate(lengths):
        n = min(left[length], room // length)
        while not reach[k + 1] & wanted >> n * length:
            n -= 1
        if n:
            taken[length] = n
            room -= n * length
            wanted >>= n * length
        if not room:
            break
    return taken


def _around_longest(left: dict[int, int], capacity: int, slack: int = 0) -> dict[int, int]:
    """The fullest combination with the longest piece."""
    longest = next(iter(left))
    room = capacity - longest
    rest = {length: n - (length == longest) for length, n in left.items() if length <= room and n > (length == longest)}
    taken = _fullest(rest, room, slack)
    taken[longest] = taken.get(longest, 0) + 1
    return dict(sorted(taken.items(), reverse=True))


def places(found: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which pieces of a length each pattern takes: length, first and last+1 of their numbers, pieces per bin, first bin, offset in it."""
    used: dict[int, int] = {}
    rows, bins_before = [], 0
    for bins, combination in found:
        offset = 0
        for length, n in combination.items():
            first = used.get(length, 0)
            used[length] = first + bins * n
            rows.append((length, first, used[length], n, bins_before, offset))
            offset += length * n
        bins_before += bins
    return rows


def packed(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    The pieces are stored first, so that texts are tokenized once.
    """
    spark = made.sparkSession
    store = work_folder(spark, "pieces")
    made.write.parquet(store)
    made = spark.read.schema(PIECES).parquet(store)
    keyed = made.withColumn("_key", F.xxhash64("doc_id", "piece", "start", "ids_crc32")).withColumn(
        "_cell", F.pmod("_key", F.lit(CELLS))
    )
    cells = keyed.groupBy("length", "_cell").agg(F.count("*").alias("n"))
    # one row per length, so at most ``capacity`` of them
    counts = {row["length"]: row["n"] for row in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.createDataFrame(
        places(patterns(counts, capacity)),
        "_length long, _first long, _last long, _n long, _bins_before long, _offset long",
    )
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        F.col("length").alias("_l"), F.col("_cell").alias("_c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    own = Window.partitionBy("length", "_cell").orderBy("_key", "doc_id", "piece")
    numbered = keyed.join(starts, (F.col("length") == F.col("_l")) & (F.col("_cell") == F.col("_c"))).withColumn(
        "_number", F.col("_before") + F.row_number().over(own) - 1
    )
    # at most capacity patterns of at most 44 different lengths each: 1 + 2 + ... + 45 is above 1024
    placed = numbered.join(
        F.broadcast(table),
        (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("_first")) & (F.col("_number") < F.col("_last")),
    )
    at = F.col("_number") - F.col("_first")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_bins_before") + F.floor(at / F.col("_n"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(at, F.col("_n")) * F.col("length")).cast("long").alias("offset"),
    )
