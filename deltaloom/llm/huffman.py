"""Canonical length-limited Huffman codes and vectorised bit packing (numpy)."""

from __future__ import annotations

import numpy as np

#: Longest code; the decoding table has 2 ** MAX_BITS entries.
MAX_BITS = 18
#: Symbols between bit-offset checkpoints.
LANE = 256


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for symbols that never occur."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 2**limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    rows, items = [], leaves
    for _ in range(limit - 1):
        half = len(items) // 2
        both = np.concatenate([leaves, items[0 : 2 * half : 2] + items[1 : 2 * half : 2]])
        place = np.argsort(both, kind="stable")
        rows.append(np.cumsum(place < len(leaves)))
        items = both[place]
    lengths, take = np.zeros(len(leaves), np.int64), 2 * len(leaves) - 2
    for leaf_counts in reversed(rows):
        n = int(leaf_counts[take - 1]) if take else 0
        lengths[:n] += 1
        take = 2 * (take - n)
    lengths[:take] += 1
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        if n := int(lengths[symbol]):
            code <<= n - last
            codes[symbol], last = code, n
            code += 1
    return codes


def decoding_table(lengths: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length by the next ``limit`` bits."""
    symbols, bits = np.zeros(2**limit, np.uint32), np.zeros(2**limit, np.uint8)
    order = [s for s in np.lexsort((np.arange(len(lengths)), lengths)).tolist() if lengths[s]]
    spans = 2 ** (limit - lengths[order].astype(np.int64))
    symbols[: spans.sum()] = np.repeat(order, spans)
    bits[: spans.sum()] = np.repeat(lengths[order], spans)
    return symbols, bits


def pack(symbols: np.ndarray, sizes: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bits of runs of symbols, each run from a whole byte on.

    Returns the bytes, the bytes of each run, and the bits of each lane: lanes are LANE
    symbols of one run (the last of a run may be shorter).
    """
    run = np.repeat(np.arange(len(sizes)), sizes)
    n_bits = lengths[symbols].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(n_bits)])
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    run_bytes = (ends[firsts[1:]] - ends[firsts[:-1]] + 7) // 8
    base = (np.cumsum(run_bytes) - run_bytes) * 8 - ends[firsts[:-1]]
    at = ends[:-1] + base[run]
    words = np.zeros(int(run_bytes.sum()) // 8 + 2, np.uint64)
    if len(symbols):
        word, left = at >> 6, 64 - (at & 63) - n_bits
        code = codes[symbols]
        fits = left >= 0
        high = np.where(fits, code << np.maximum(left, 0).astype(np.uint64), code >> np.maximum(-left, 0).astype(np.uint64))
        new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[new]] = np.bitwise_or.reduceat(high, new)
        over = np.flatnonzero(~fits)
        words[word[over] + 1] |= code[over] << (64 + left[over]).astype(np.uint64)
    lanes = -(-sizes // LANE)
    owner = np.repeat(np.arange(len(sizes)), lanes)
    start = firsts[owner] + (np.arange(len(owner)) - (np.cumsum(lanes) - lanes)[owner]) * LANE
    stop = np.minimum(start + LANE, firsts[owner + 1])
    return words.byteswap().tobytes()[: int(run_bytes.sum())], run_bytes, ends[stop] - ends[start]


def unpack(data: bytes, sizes: np.ndarray, run_bytes: np.ndarray, lane_bits: np.ndarray, table: tuple[np.ndarray, np.ndarray], limit: int = MAX_BITS) -> np.ndarray:
    """Symbols of all runs: every lane decodes by itself, all lanes step together."""
    lanes = -(-sizes // LANE)
    owner = np.repeat(np.arange(len(sizes)), lanes)
    rank = np.arange(len(owner)) - (np.cumsum(lanes) - lanes)[owner]
    before = np.cumsum(lane_bits) - lane_bits
    first = (np.cumsum(lanes) - lanes)[owner]
    at = (np.cumsum(run_bytes) - run_bytes)[owner] * 8 + (before - before[first] if len(owner) else before)
    count = np.minimum(sizes[owner] - rank * LANE, LANE)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(LANE * limit // 8 + 8, np.uint8)]).astype(np.uint32)
    wide = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
    out = np.zeros((LANE, len(owner)), np.uint32)
    symbols, bits = table
    for step in range(int(count.max(initial=0))):
        index = (wide[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - limit)
        out[step] = symbols[index]
        at = at + bits[index]
    return out.T[np.arange(LANE) < count[:, None]]
