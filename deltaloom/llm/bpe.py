"""Byte-level BPE encoding and decoding as a tree reduction over a text's bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, small_batches, text_or_empty

#: All characters that some engine counts as white space (fixed values).
UNICODE_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
#: Bytes, about, of each generation of a worker's memory, and the longest key that is remembered.
MEMORY, LONGEST = 48 << 20, 64
#: What an entry takes besides its key and value.
ENTRY = 200
#: Characters of texts that are encoded before their rows are handed on.
SLICE = 1 << 20


class Memory(dict):
    """Computed values by key, in two generations of about ``limit`` bytes each; long keys are computed anew."""

    def __init__(self, compute: Callable, limit: int = MEMORY):
        super().__init__()
        self.compute, self.limit, self.older, self.held = compute, limit, {}, 0

    def __missing__(self, key: bytes | str):
        if len(key) > LONGEST:
            return self.compute(key)
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if self.held >= self.limit:
            self.older, self.held = dict(self), 0
            self.clear()
        self[key] = value
        self.held += ENTRY + len(key) + len(value)
        return value

    def rest(self) -> None:
        """Between tasks a worker keeps the younger generation only."""
        self.older = {}


def text_slices(column: pa.StringArray) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a batch's column, so that only so many characters are Python strings at once."""
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE, "right")))
        yield at, column.slice(at, end - at).to_pylist()
        at = end


_BESIDE_SPACE = re.compile(f" (?:[{UNICODE_SPACES}]|$)")


def splits_at_spaces(text: str) -> bool:
    """Whether the byte-level pattern matches the chunks between spaces apart from each other.

    It never matches across the cut before a space: there is always a match end there, unless
    white space stands on both sides of it. Texts with such a space (or one at the end) go to
    the pattern whole.
    """
    return not text.endswith(" ") and _BESIDE_SPACE.search(text) is None


def spaced_chunks(text: str) -> list[str] | None:
    """The text cut before spaces, where each chunk but the first stands for ' ' + chunk; None for texts that go whole."""
    return text.split(" ") if splits_at_spaces(text) else None


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeEncoder:
    """Ids of byte strings by joining the ids of their halves.

    A sequence of tokens is the BPE encoding of its bytes exactly if each neighbouring pair
    is the encoding of the pair's own bytes. So two encoded neighbours are joined by encoding a
    window around the seam anew: once its first and last tokens are those that stood there
    before, every pair outside is one that was valid already, and nothing further out can
    change. Until then the window doubles.
    """

    def __init__(self, ranks: dict[bytes, int], memory: int = MEMORY):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.halves = Memory(self.encode, memory // 4)
        self.seams = Memory(self._merge, memory // 4)

    def _merge(self, data: bytes) -> tuple[int, ...]:
        """Pair merging by rank, leftmost first among equals, for the windows at seams."""
        ranks, none = self.ranks, len(self.tokens)
        if len(data) <= 24:
            return self._merge_short(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(len(data))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(rank, i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (rank := ranks.get(a + b, none)) < none]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != pair:
                continue
            parts[i], parts[j] = pair, None
            after[i] = k = after[j]
            if k < len(parts):
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if 0 <= x and y < len(parts) and (rank := ranks.get(joined := parts[x] + parts[y], none)) < none:
                    heapq.heappush(heap, (rank, x, joined))
        return tuple(ranks[p] for p in parts if p is not None)

    def _merge_short(self, data: bytes) -> tuple[int, ...]:
        rank_of, none = self.ranks.get, len(self.tokens)
        parts = [data[i : i + 1] for i in range(len(data))]
        found = [rank_of(data[i : i + 2], none) for i in range(len(data) - 1)]
        while found and (least := min(found)) < none:
            i = found.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = rank_of(parts[i - 1] + parts[i], none)
            if i < len(found):
                found[i] = rank_of(parts[i] + parts[i + 1], none)
        return tuple([self.ranks[p] for p in parts])

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right:
            return left or right
        if self.seams[self.tokens[left[-1]] + self.tokens[right[0]]] == (left[-1], right[0]):
            return left + right
        width = 1
        while True:
            a, b = left[-width:], right[:width]
            window = self.seams[b"".join([self.tokens[i] for i in a + b])] if width <= 2 else self._merge(self.decode(a + b))
            if (width >= len(left) or window[0] == a[0]) and (width >= len(right) or window[-1] == b[-1]):
                return left[:-width] + window + right[width:]
            width *= 2

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Ids of a byte string taken as one piece, without any split by a pattern."""
        if (rank := self.ranks.get(data)) is not None:
            return (rank,)
        if len(data) < 2:
            return ()
        cut = len(data) // 2
        a, b = data[:cut], data[cut:]
        if len(data) > 64:
            return self.join(self.encode(a), self.encode(b))
        return self.join(self.halves[a], self.halves[b])

    def decode(self, ids: tuple[int, ...] | list[int]) -> bytes:
        """Bytes of ids: leaves of 4,096 ids, concatenated up the tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class TextEncoder:
    """Texts to packed ids: the pattern's matches are encoded one by one, repeated ones from memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY):
        self.tree = TreeEncoder(ranks, memory)
        self.pattern = regex.compile(pattern)
        self.pieces = Memory(lambda piece: self.pack(self.tree.encode(piece.encode())), memory // 4)
        self.chunks = Memory(self._spaced, memory)

    @staticmethod
    def pack(ids: tuple[int, ...]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    def _spaced(self, chunk: str) -> bytes:
        """Ids of a space and the chunk: one match of the pattern, or several, each from memory."""
        found = self.pattern.findall(" " + chunk)
        return self.pack(self.tree.encode(found[0].encode())) if len(found) == 1 else b"".join(map(self._piece, found))

    def _piece(self, piece: str) -> bytes:
        # A space and what isn't white space is one match by itself too, so it is the chunk after the space.
        return self.chunks[piece[1:]] if len(piece) > 1 and piece[0] == " " and not piece[1].isspace() else self.pieces[piece]

    def whole(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.pattern.findall(text)))

    def rest(self) -> None:
        for memory in (self.pieces, self.chunks, self.tree.halves, self.tree.seams):
            memory.rest()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        chunks = spaced_chunks(text)
        if chunks is None:
            return self.whole(text)
        return self.whole(chunks[0]) + b"".join(map(self.chunks.__getitem__, chunks[1:]))

    def decode(self, packed: bytes) -> bytes:
        return self.tree.decode(np.frombuffer(packed, "<u4").tolist())


_ENCODERS: dict[tuple[str, str, int], TextEncoder] = {}


def text_encoder(path: str, pattern: str, memory: int = MEMORY) -> TextEncoder:
    """One encoder a worker process, vocabulary and bound of memory."""
    if (path, pattern, memory) not in _ENCODERS:
        _ENCODERS[path, pattern, memory] = TextEncoder(read_ranks(path), pattern, memory)
    return _ENCODERS[path, pattern, memory]


def bpe_encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of whole texts: doc_id, ids (binary, little-endian unsigned 32-bit).

    ``vocabulary`` is a rank file that every worker can open. Null text counts as empty and
    gives no ids; ids may be null or repeat; other columns are ignored; one narrow pass
    without any shuffle. Memory of a task: one Arrow batch, and tables of chunks seen before
    that are bounded in bytes.
    """

    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary, pattern)
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                ids = [encoder.encode(text) for text in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        encoder.rest()

    source = pick(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    return source.mapInArrow(encode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids binary")


def bpe_decode(encoded: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of ids: doc_id, data (binary). Null ids give empty bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary, pattern)
        for batch in batches:
            data = [encoder.decode(ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    source = pick(encoded, doc_id=id_col, ids=ids_col)
    return source.mapInArrow(decode, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, data binary")


def bpe_digests(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY) -> DataFrame:
    """A round trip in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256 for each text.

    ``memory`` bounds, in bytes, each generation of a worker's table of chunks, and with a quarter of it
    each of the three other tables. Less memory costs time where texts have many words; ids don't change.
    """
    small_batches(docs.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary, pattern, memory)
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                rows = []
                for text in texts:
                    packed = encoder.encode(text)
                    rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(encoder.decode(packed)).hexdigest()))
                n, ids, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(rows)), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        encoder.rest()

    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id"), text_or_empty().alias("text"))
    return source.mapInArrow(digest, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
