"""Words of Arrow text columns as numpy arrays: where each begins and ends, whose it is, and a 64-bit hash.

A word is a longest run of characters other than the six ASCII white-space characters, so it can be found on the UTF-8
bytes. Texts are handled in slices of a few megabytes (or one text, if longer), which bounds the memory of a task. Where nothing is
gained by large ones, slices of ``SMALL_SLICE_BYTES`` keep the arrays, which have 8 bytes per byte of text, in a core's cache.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
SMALL_SLICE_BYTES = 1 << 17

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_STEP = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that close inputs give unrelated outputs."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(_STEP)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))
_LOWER_VALUES = _BYTE_VALUES[_LOWER]
_BASE = 0xD6E8FEB86659FD93
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n + (n >> 2), 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers


class Slice(NamedTuple):
    """Some whole texts of a batch: rows first to last, their bytes, and their words."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray  # of the texts, in bytes; last - first + 1 entries
    starts: np.ndarray  # of the words, in bytes
    ends: np.ndarray
    text: np.ndarray  # of each word, the text it belongs to, counted from first
    hashes: np.ndarray

    def bounds(self) -> np.ndarray:
        """Where each text's words begin among all words of the slice, and their end."""
        return np.searchsorted(self.text, np.arange(self.last - self.first + 1))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def word_slices(column: pa.Array, lower: bool = False, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """The words of each row's whole text. lower: A to Z count as a to z in the hashes."""
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + slice_bytes, "right")) - 1)
        last = min(last, rows)
        own = offsets[first : last + 1] - offsets[first]
        yield _sliced(first, last, data[offsets[first] : offsets[last]], own, lower)
        first = last


def _sliced(first: int, last: int, data: np.ndarray, offsets: np.ndarray, lower: bool) -> Slice:
    n = len(data)
    word = ~_SPACES[data]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    inner = offsets[:-1][offsets[:-1] < n]
    begins[inner] = word[inner]
    before = inner[inner > 0] - 1
    stops[before] = word[before]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    powers, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((_LOWER_VALUES if lower else _BYTE_VALUES)[data] * powers[:n], out=total[1:])
        hashes = (total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_STEP)
    text = np.searchsorted(offsets, starts, "right") - 1
    return Slice(first, last, data, offsets, starts, ends, text, mixed(hashes))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span of data."""
    powers, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_VALUES[data] * powers[: len(data)], out=total[1:])
        return mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_STEP))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k successive word hashes (of the whole sequence, if it is shorter)."""
    k = min(k, len(hashes))
    n = len(hashes) - k + 1 if k else 0
    out = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mixed(out * np.uint64(_BASE) + hashes[i : i + n])
    return out
