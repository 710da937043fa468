"""Hashes of the words of many texts at once, straight from Arrow's buffers (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed together; a longer text goes alone.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_slices(column: pa.StringArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of runs of texts of about a slice each."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the number of words of each text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z as a-z on request)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    inside = np.arange(total) - np.repeat(before, lengths)
    letters = data[np.repeat(starts, lengths) + inside]
    if lower:
        letters = _LOWER[letters]
    terms = (letters.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[inside]
    return mixed(np.add.reduceat(terms, before) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(words: np.ndarray, counts: np.ndarray, size: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside each text, and the runs of each text.

    With ``short``, a text of fewer words has one run: all of its words.
    """
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    weights = powers(size, np.uint64(0xC2B2AE3D27D4EB4F))
    runs = np.maximum(counts - size + 1, (counts > 0).astype(np.int64) if short else 0)
    text = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + (np.cumsum(counts) - counts)[text]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    left = (np.cumsum(counts))[text] - at
    for j in range(size):
        term = padded[at + j] * weights[j]
        out += np.where(j < left, term, np.uint64(0)) if short else term
    return mixed(out), runs
