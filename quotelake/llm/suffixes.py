"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than the one after them. The substrings between leftmost S suffixes are sorted by inducing, named in order
and, unless all names differ, the string of names is sorted recursively; from the sorted leftmost S suffixes all others are induced in one
pass over the buckets upwards (L) and one downwards (S). Buckets are induced one at a time with array operations: what a bucket induces into itself
follows in waves. Names are many, so a long string of names is written with two digits for each, which keeps the order of its suffixes and leaves few, large
buckets (where about a third of the symbols are leftmost ones, so that the string gets shorter all the same); others are induced suffix by suffix.

The permuted common prefix of a position is the length that its suffix shares with the one before it in the array. It is at least that of the position
before, less one; it is compared only where the two preceding symbols differ, and follows by that rule elsewhere.
"""

from __future__ import annotations

import numpy as np

# Strings of names from this length on are written in digits.
LONG_NAMES = 150_000
FEW_SYMBOLS = 1024


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them; the last symbol is the least of all and counts as such."""
    n = len(text)
    change = np.diff(text.astype(np.int64))
    at = np.where(change != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = change[following] > 0
    return out


def _induce_buckets(text: np.ndarray, small: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    n = len(text)
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    heads = ends - counts
    array = np.full(n, -1, np.int64)

    def grouped(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes by first symbol in unchanged order, their places within a symbol, and the numbers of each symbol."""
        symbols = text[found]
        order = np.argsort(symbols, kind="stable")
        found, symbols = found[order], symbols[order]
        n_of = np.bincount(symbols, minlength=size)
        place = np.arange(len(found)) - (np.cumsum(n_of) - n_of)[symbols]
        return found, symbols, place, n_of

    found, symbols, place, n_of = grouped(leftmost)
    array[ends[symbols] - n_of[symbols] + place] = found
    first_leftmost = ends - n_of

    fill = heads.copy()

    def push_larger(source: np.ndarray) -> None:
        before = source[source > 0] - 1
        before = before[~small[before]]
        if len(before):
            found, symbols, place, n_of = grouped(before)
            array[fill[symbols] + place] = found
            np.add(fill, n_of, out=fill)

    used = np.flatnonzero(counts)
    for c in used:
        at = heads[c]
        while at < fill[c]:
            at, upto = fill[c], at
            push_larger(array[upto:at])
        push_larger(array[first_leftmost[c] : ends[c]])

    larger_ends = fill
    fill = ends.copy()
    last = n - 1  # the least suffix stays in front; nothing induces it

    def push_smaller(source: np.ndarray) -> None:
        before = source[source > 0] - 1
        before = before[small[before]]
        if len(before):
            found, symbols, place, n_of = grouped(before)
            array[fill[symbols] - 1 - place] = found
            np.subtract(fill, n_of, out=fill)

    for c in used[::-1]:
        at = ends[c]
        while at > fill[c]:
            at, upto = fill[c], at
            push_smaller(array[at:upto][::-1])
        push_smaller(array[heads[c] : larger_ends[c]][::-1])
    array[0] = last
    return array


def _induce_suffixes(text: np.ndarray, small: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    array = [-1] * len(text)
    symbols, smaller = text.tolist(), small.tolist()
    fill = ends.tolist()
    for k in leftmost[::-1].tolist():
        c = symbols[k]
        fill[c] -= 1
        array[fill[c]] = k
    fill = (ends - counts).tolist()
    for k in range(len(array)):
        j = array[k] - 1
        if j >= 0 and not smaller[j]:
            c = symbols[j]
            array[fill[c]] = j
            fill[c] += 1
    fill = ends.tolist()
    for k in range(len(array) - 1, -1, -1):
        j = array[k] - 1
        if j >= 0 and smaller[j]:
            c = symbols[j]
            fill[c] -= 1
            array[fill[c]] = j
    array[0] = len(array) - 1
    return np.array(array, np.int64)


def _names(text: np.ndarray, leftmost: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """A rank for the substring from each leftmost S suffix to the next, by position; equal ones share it."""
    number = np.full(len(text), -1, np.int64)
    number[leftmost] = np.arange(len(leftmost))
    lengths = np.append(np.diff(leftmost), 0)
    k = number[in_order]
    length = lengths[k]
    differs = np.ones(len(in_order), bool)
    alive = np.flatnonzero(length[1:] == length[:-1]) + 1
    differs[alive] = False
    step = 0
    while len(alive):
        # the last symbol of a substring is the first of the next one, so it counts
        alive = alive[length[alive] >= step]
        other = text[in_order[alive] + step] != text[in_order[alive - 1] + step]
        differs[alive[other]] = True
        alive = alive[~other]
        step += 1
    names = np.empty(len(leftmost), np.int64)
    names[k] = np.cumsum(differs) - 1
    return names


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """The suffix array of symbols 0 to size - 1, whose last symbol is 0 and occurs nowhere else."""
    if len(text) < 2:
        return np.arange(len(text))
    induce = _induce_buckets if len(text) >= LONG_NAMES and size <= FEW_SYMBOLS else _induce_suffixes
    small = _smaller(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[leftmost] = True
    induced = induce(text, small, leftmost, size)
    in_order = induced[is_leftmost[induced]]
    names = _names(text, leftmost, in_order)
    different = int(names.max()) + 1
    if different < len(leftmost):
        in_order = leftmost[_by_names(names, different, len(text))]
    return induce(text, small, in_order, size)


def _by_names(names: np.ndarray, different: int, above: int) -> np.ndarray:
    base = int(np.ceil(np.sqrt(different)))
    if len(names) < LONG_NAMES or base >= FEW_SYMBOLS or 2 * len(names) > 0.9 * above:
        return suffix_array(names, different)
    digits = np.zeros(2 * len(names) + 1, np.int16)
    digits[:-1:2], digits[1::2] = names // base + 1, names % base + 1
    array = suffix_array(digits, base + 1)
    return array[(array % 2 == 0) & (array < len(digits) - 1)] // 2


def permuted_common_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each position, the symbols its suffix shares with the suffix before it in the array. text: as in ``suffix_array``."""
    n = len(text)
    before = np.empty(n, np.int64)
    before[array[1:]] = array[:-1]
    before[array[0]] = -1
    compared = np.ones(n, bool)
    later = np.arange(1, n)
    own = before[1:]
    known = own > 0
    compared[1:][known] = text[later[known] - 1] != text[own[known] - 1]
    start = np.flatnonzero(compared)
    shared = np.zeros(len(start), np.int64)
    alive = np.flatnonzero(before[start] >= 0)
    step = 0
    while len(alive):
        alive = alive[text[start[alive] + step] == text[before[start[alive]] + step]]
        step += 1
        shared[alive] = step
    # elsewhere one less than at the position before
    last = np.cumsum(compared) - 1
    return shared[last] - (np.arange(n) - start[last])
