"""Terms of whole texts on their UTF-8 bytes: longest runs of ASCII letters, digits and characters beyond ASCII, A to Z lower-cased.

Texts are handled in slices of a few megabytes (or one text, if longer), which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from quotelake.llm import words as W

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Terms(NamedTuple):
    """Some whole texts of a column: rows first to last, and their terms, joined by single spaces in data."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray  # of the terms in data
    ends: np.ndarray
    bounds: np.ndarray  # where each text's terms begin among all, and their end; last - first + 1 entries


def term_slices(column: pa.Array, slice_bytes: int = W.SLICE_BYTES) -> Iterator[Terms]:
    """The terms of each row's whole text; a null text has none."""
    data, offsets = W.text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + slice_bytes, "right")) - 1)
        last = min(last, rows)
        yield _terms(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def _terms(first: int, last: int, data: np.ndarray, offsets: np.ndarray) -> Terms:
    inside = _TERM[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[:-1][(offsets[:-1] < len(data)) & (offsets[:-1] > 0)]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.searchsorted(starts, offsets)
    lengths = ends - starts
    packed = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    new_ends = np.cumsum(lengths + 1) - 1
    new_starts = new_ends - lengths
    keep = np.ones(len(packed), bool)
    keep[new_ends] = False
    packed[keep] = W._LOWER[data[inside]]
    return Terms(first, last, packed, new_starts, new_ends, bounds)
