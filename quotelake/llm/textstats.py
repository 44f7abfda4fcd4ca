"""Counts over the words, lines and characters of whole texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from quotelake.llm import words as W

SYMBOLS = b"#*$%&|<>"
STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_ended",
    "n_distinct",
    "n_doubled",
)


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(characters)] = 1
    return out


_COUNTED = {
    "n_symbols": _table(SYMBOLS),
    "n_upper": _table(bytes(range(ord("A"), ord("Z") + 1))),
    "n_digits": _table(b"0123456789"),
    "n_marks": _table(b"!?"),
}
_LEAD = np.array([int(b & 0xC0 != 0x80 and not W._SPACES[b]) for b in range(256)])
_ENDS = _table(b".,;:!?")


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def slice_statistics(s: W.Slice) -> dict[str, np.ndarray]:
    """The statistics of each text of a slice.

    A line counts as repeated if it has a word and equals an earlier line of its text; a word counts as repeated if it lies in a
    window of three words that its text has twice or more. Equality is that of 64-bit hashes.
    """
    n = s.last - s.first
    count = lambda per_byte: (t := np.concatenate(([0], np.cumsum(per_byte))))[s.offsets[1:]] - t[s.offsets[:-1]]
    per_text = lambda flags: np.bincount(s.text[flags], minlength=n)
    out = {name: count(weights[s.data]) for name, weights in _COUNTED.items()}
    out["n_words"] = np.bincount(s.text, minlength=n)
    out["word_chars"] = count(_LEAD[s.data])
    out["n_ended"] = per_text(_ENDS[s.data[s.ends - 1]] > 0) if len(s.ends) else np.zeros(n, np.int64)

    salt = W.mixed(np.arange(n, dtype=np.uint64))
    keyed = s.hashes ^ salt[s.text]
    out["n_distinct"] = np.bincount(s.text[np.unique(keyed, return_index=True)[1]], minlength=n) if len(keyed) else np.zeros(n, np.int64)
    windows = W.shingles(s.hashes, 3) ^ salt[s.text[: len(s.hashes) - 2]] if len(s.hashes) > 2 else np.zeros(0, np.uint64)
    whole = np.flatnonzero(s.text[: len(windows)] == s.text[2:]) if len(windows) else np.zeros(0, np.int64)
    twice = whole[_repeats(windows[whole])] if len(whole) else whole
    covered = np.zeros(len(s.hashes), bool)
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = per_text(covered)

    doubled = np.flatnonzero((s.hashes[1:] == s.hashes[:-1]) & (s.text[1:] == s.text[:-1]))
    out["n_doubled"] = np.bincount(s.text[doubled], minlength=n)

    # lines with a word: the words between two line ends, told apart by the hash of all bytes from line start to line end
    breaks = np.flatnonzero(s.data == 0x0A)
    edges = np.unique(np.concatenate((s.offsets, breaks, breaks + 1)))
    starts, ends = edges[:-1], edges[1:]
    filled = np.searchsorted(s.starts, ends) > np.searchsorted(s.starts, starts)
    starts, ends = starts[filled], ends[filled]
    text = np.searchsorted(s.offsets, starts, "right") - 1
    keys = W.span_hashes(s.data, starts, ends) ^ salt[text] if len(starts) else np.zeros(0, np.uint64)
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    out["n_lines"] = np.bincount(text, minlength=n)
    out["n_dup_lines"] = np.bincount(text[~first], minlength=n)
    return out


def batch_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    parts = [slice_statistics(s) for s in W.word_slices(column, slice_bytes=W.SMALL_SLICE_BYTES)]
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, np.int64) for name in STATISTICS}


def with_statistics(batches: Iterator[pa.RecordBatch], keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: the columns to keep, then the statistics of ``text``."""
    for batch in batches:
        found = batch_statistics(batch.column("text"))
        columns = [batch.column(name) for name in keep] + [pa.array(found[name].astype(np.int64)) for name in STATISTICS]
        yield pa.RecordBatch.from_arrays(columns, names=[*keep, *STATISTICS])


def ratios(s: dict[str, np.ndarray]) -> np.ndarray:
    """The features of texts, one row each: shares of the counts, on scales that don't depend on a text's length."""
    n = np.maximum(s["n_words"], 1).astype(float)
    chars = np.maximum(s["word_chars"], 1).astype(float)
    return np.stack(
        [
            s["n_symbols"] / n,
            s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
            s["n_repeat_words"] / n,
            s["word_chars"] / n,
            s["n_upper"] / chars,
            s["n_digits"] / chars,
            s["n_marks"] / n,
            s["n_ended"] / n,
            s["n_doubled"] / n,
        ],
        axis=1,
    )


RATIOS = (
    "symbols_per_word",
    "repeated_lines",
    "repeated_words",
    "word_length",
    "capitals",
    "digits",
    "marks_per_word",
    "ended_words",
    "doubled_words",
)
