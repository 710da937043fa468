"""Terms of texts and their counts by length-bucketed packing (numpy).

A term of up to eight bytes is one big-endian 64-bit word, one of up to sixteen is two; no
term holds a zero byte, so padding keeps them apart and numbers sort like bytes. Longer terms have a
bucket for each length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .words import word_spans

#: Bytes as terms see them: A-Z as a-z, letters and bytes of characters beyond ASCII as they are, all else a space.
_TERM_BYTES = np.full(256, 0x20, np.uint8)
_TERM_BYTES[0x80:] = np.arange(0x80, 0x100)
_TERM_BYTES[0x61:0x7B] = _TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, byte starts and ends of the terms in them, and the number of terms of each text."""
    lowered = _TERM_BYTES[data]
    return lowered, *word_spans(lowered, offsets)


def radix_order(columns: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order`` sorted stably by the columns of 64-bit words, the first foremost: one pass of 16 bits after the other from the last."""
    for column in reversed(columns):
        for shift in (0, 16, 32, 48):
            digit = ((column >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _words(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes of each term, zeros after its end, as a big-endian number."""
    at_every_byte = np.ndarray(len(padded) - 7, ">u8", padded, strides=(1,))
    free = (np.uint64(8) - np.minimum(lengths, 8).astype(np.uint64)) * np.uint64(8)
    return (at_every_byte[starts].astype(np.uint64) >> free) << free


def _runs(columns: list[np.ndarray], owner: np.ndarray, group_of: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of entries in an order that sorts by columns and then by owner: first entry, group, entries and owners of each run of one term and group."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    owners = owner[order]
    new_owner = new.copy()
    new_owner[1:] |= owners[1:] != owners[:-1]
    groups = group_of[owners]
    new[1:] |= groups[1:] != groups[:-1]
    at = np.flatnonzero(new)
    return order[at], groups[at], np.diff(np.append(at, len(order))), np.add.reduceat(new_owner.astype(np.int64), at)


def count_terms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, group_of: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket, its distinct (term, group): terms, groups, occurrences and owners that have the term.

    ``owner`` is each term's text and ``group_of`` each text's group; texts must be numbered so that
    groups ascend.
    """
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    by_owner = radix_order([owner.astype(np.uint64)], np.arange(len(owner)))
    wide = lengths[by_owner]
    for least, most in ((1, 8), (9, 16)):
        order = by_owner[(wide >= least) & (wide <= most)]
        if not len(order):
            continue
        s, n, o = starts[order], lengths[order], owner[order]
        columns = [_words(padded, s + at, n - at) for at in range(0, most, 8)]
        first, groups, counts, owners = _runs(columns, o, group_of, radix_order(columns, np.arange(len(order))))
        packed = np.stack([c[first] for c in columns], axis=1).astype(">u8")
        yield packed.view(f"S{most}").ravel().tolist(), groups, counts, owners
    for length in np.unique(lengths[lengths > 16]).tolist():
        order = by_owner[wide == length]
        raw = memoryview(np.ascontiguousarray(data))
        terms = np.array([bytes(raw[a : a + length]) for a in starts[order].tolist()], f"S{length}")
        o = owner[order]
        first, groups, counts, owners = _runs([terms], o, group_of, np.argsort(terms, kind="stable"))
        yield terms[first].tolist(), groups, counts, owners
