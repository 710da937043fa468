"""Near-duplicate documents by SimHash: fingerprints of shingles, bit-sliced comparison, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_checked, pick, small_batches, stored
from .linking import connected_components

#: Words of a shingle, seed of its hash, and the differing bits up to which fingerprints link.
WORDS, SEED, RADIUS = 3, 42, 2
#: Bands of a fingerprint. Of four, two differing bits leave two alike, which are a bucket's key.
BANDS = 4
#: Fingerprints of a bucket beyond which its pairs are sought by two quarters of the remaining bits too.
LARGE = 1_024
#: Entries that are compared together; buckets are never cut, and have LARGE or, with 16 free bits, 65,536 at most.
BLOCK = 1 << 16
#: Shingles that are hashed before their bits are counted.
SLICE = 1 << 16
#: Bit planes between two looks for words of lanes that can be abandoned.
STEP = 8
#: Planes in an order that takes the bands in turn, so every bucket meets bits outside its key early.
PLANES = [16 * band + bit for bit in range(16) for band in range(BANDS)]


def simhash(data: bytes, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a UTF-8 text: a bit is set if it is in over half the shingles' hashes.

    Shingles are runs of ``words`` words (A-Z as a-z) joined by spaces, repeats included; a text of
    fewer words is one shingle, one without words has fingerprint 0.
    """
    plain = b" ".join(data.lower().split())
    if not plain:
        return 0
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    n = max(1, len(gaps) + 2 - words)
    first, last = np.concatenate([[0], gaps + 1])[:n], np.concatenate([gaps, [len(plain)]])[-n:]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        spans = zip(first[at : at + SLICE].tolist(), last[at : at + SLICE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(plain[a:b], SEED) for a, b in spans], np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int((2 * counts > n) @ (1 << np.arange(64, dtype=object)))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(doc_id, print) for each row; a null text counts as empty."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(x or b"", words) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "print"])

    small_batches(docs.sparkSession)
    source = pick(docs, doc_id=id_col, text=text_col)
    return source.mapInArrow(sign, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, print long")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """The fingerprints stored vertically: row b holds bit PLANES[b] of all of them, 64 to a word, and one word of padding."""
    padded = np.zeros((len(prints) // 64 + 2) * 64, np.uint64)
    padded[: len(prints)] = prints
    return np.stack([np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(bool), bitorder="little").view(np.uint64) for b in PLANES])


def _lanes(mask: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 64, bool)
    out[: len(mask)] = mask
    return np.packbits(out, bitorder="little").view(np.uint64)


def _near(planes: np.ndarray, shifted: np.ndarray, whole: int, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Lanes i of ``lanes`` whose entries i and i + distance differ in ``radius`` bits or fewer.

    ``shifted`` are the planes moved by the distance modulo 64 and ``whole`` is its number of
    words. Two carry-save counters hold each lane's differing bits up to 3; words in which all
    lanes exceed the radius are abandoned.
    """
    at = np.flatnonzero(lanes)
    live = lanes[at]
    ones, twos = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for step in range(0, len(PLANES), STEP):
        for b in range(step, step + STEP):
            x = planes[b, at] ^ shifted[b, at + whole]
            carry = ones & x
            ones ^= x
            live &= ~(twos & carry)
            twos ^= carry
            if radius == 2:
                live &= ~(ones & twos)
            elif radius == 1:
                live &= ~twos
            else:
                live &= ~(ones | twos)
        keep = np.flatnonzero(live)
        if not len(keep):
            return np.zeros(0, np.int64)
        if len(keep) < len(at):
            at, live, ones, twos = at[keep], live[keep], ones[keep], twos[keep]
    bits = np.unpackbits(live.view(np.uint8), bitorder="little").reshape(len(at), 64)
    word, bit = np.nonzero(bits)
    return at[word] * 64 + bit


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the labels a[k] and b[k] for all k; labels are the least index of their component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for x, y in set(zip(label[a].tolist(), label[b].tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    moved = np.arange(len(label))
    old = np.fromiter(parent, np.int64, len(parent))
    moved[old] = [root(x) for x in old.tolist()]
    return moved[label]


def linked_runs(keys: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For entries sorted by key, the first entry of each one's component within its run of equal keys.

    All pairs of a run at distance d are compared at once, for d = 1, 2, ... up to the longest run;
    pairs whose entries are connected already are left out.
    """
    n = len(keys)
    label = np.arange(n)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))
    left = np.repeat(starts + sizes, sizes) - label  # entries from this one to the end of its run
    longest = int(sizes.max())
    if longest < 2:
        return label
    planes = bit_planes(prints)
    words = planes.shape[1]
    for rest in range(min(64, longest)):
        shifted = planes
        if rest:
            shifted = planes >> np.uint64(rest)
            shifted[:, :-1] |= planes[:, 1:] << np.uint64(64 - rest)
        for d in range(rest or 64, longest, 64):
            lanes = _lanes((left[:-d] > d) & (label[:-d] != label[d:]), words)
            found = _near(planes, shifted, d // 64, lanes, radius)
            if len(found):
                label = _merge(label, found, found + d)
    return label


def _compare(radius: int):
    """Entries (key, print) sorted by key to edges (a, b): each linked entry with the first of its component in its bucket."""

    def edges(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        label = linked_runs(keys, prints.view(np.uint64), radius)
        own = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(prints[label[own]]), pa.array(prints[own])], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            held.append((batch.column("key").to_numpy(), batch.column("print").to_numpy()))
            size += batch.num_rows
            if size < BLOCK:
                continue
            keys, prints = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(keys, keys[-1]))  # the last run may go on
            if cut:
                yield edges(keys[:cut], prints[:cut])
            held, size = [(keys[cut:], prints[cut:])], len(keys) - cut
        if size:
            yield edges(*(np.concatenate(x) for x in zip(*held)))

    return compare


def _bits(at: int, width: int) -> Column:
    return F.shiftrightunsigned("print", at).bitwiseAND((1 << width) - 1)


def _packed(*parts: Column | int, width: int) -> Column:
    out = F.lit(0).cast("long")
    for x in parts:
        out = F.shiftleft(out, width).bitwiseOR(x if isinstance(x, Column) else F.lit(x))
    return out


def _keys() -> Column:
    """The keys of a fingerprint, two whole bands each."""
    return F.array(*[_packed(c, _bits(16 * i, 16), _bits(16 * j, 16), width=16) for c, (i, j) in enumerate(combinations(range(BANDS), 2))])


def _finer_keys() -> Column:
    """For an entry of a large bucket, the keys with two of the four quarters of its other 32 bits."""
    choices = []
    for c, pair in enumerate(combinations(range(BANDS), 2)):
        quarters = [8 * q for band in range(BANDS) if band not in pair for q in (2 * band, 2 * band + 1)]
        finer = [_packed(8 + 6 * c + k, *[_bits(16 * x, 16) for x in pair], _packed(_bits(q, 8), _bits(r, 8), width=8), width=16) for k, (q, r) in enumerate(combinations(quarters, 2))]
        choices.append(F.array(*finer))
    number = F.shiftrightunsigned("key", 32)
    out = choices[-1]
    for c in range(len(choices) - 2, -1, -1):
        out = F.when(number == c, choices[c]).otherwise(out)
    return out


def link_prints(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Components of the graph that links fingerprints at ``radius`` (0 to 2) or fewer differing bits.

    ``prints`` is a stored frame of distinct fingerprints (print). Returns (id, label) for those with
    a link. Two fingerprints within the radius have two of four bands in common and so
    meet in a bucket. In a bucket of more than LARGE they have two of four quarters of the other 32 bits
    in common too, so its entries go to buckets of these, which have 16 free bits and 65,536
    distinct members at most. Every pair of a bucket is compared unless both are connected
    already; a bucket gives one edge for each member but the first of a component.
    """
    if radius not in range(RADIUS + 1):
        raise ValueError(f"radius must be 0 to {RADIUS}")
    entries = prints.select("print", F.explode(_keys()).alias("key"))
    large = stored(entries.groupBy("key").count().where(F.col("count") > LARGE).select("key"), "large-buckets")
    few = join_checked(entries, large, "key", "left_anti")
    many = join_checked(entries, large, "key", "left_semi").select("print", F.explode(_finer_keys()).alias("key"))
    both = few.select("key", "print").unionByName(many).repartition("key").sortWithinPartitions("key")
    return connected_components(both.mapInArrow(_compare(radius), "a long, b long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Documents connected by links between SimHash fingerprints.

    Returns one row per input row: doc_id, fingerprint (16 lowercase hex digits) and component_id,
    the least id reachable over links of ``radius`` or fewer differing bits, its own included.
    Null, empty and blank texts have fingerprint 0 and link like any other. Rows that repeat an id stay
    rows; null ids are never a component_id beside others. An empty table gives no rows; extra
    columns are ignored. Equal fingerprints collapse before buckets are formed, so a
    group of copies costs one entry.
    """
    signed = stored(fingerprints(docs, id_col, text_col, words), "simhashes")
    prints = stored(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    labels = link_prints(prints.select("print"), radius).withColumnRenamed("id", "print")
    labelled = stored(join_checked(prints, labels, "print", "left").withColumn("label", F.coalesce("label", "print")), "labelled")
    least = stored(labelled.groupBy("label").agg(F.min("least").alias("component_id")), "components")
    components = stored(join_checked(labelled, least, "label").select("print", "component_id"), "component-of-print")
    return join_checked(signed, components, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
