"""One-permutation MinHash as Column expressions: one hash a shingle, binned once."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed probe rounds before an empty bin looks at all filled ones.
PROBES = 6


def binned_minima(df: DataFrame, grams: str, out: str, bins: int, used: int | None = None) -> DataFrame:
    """Add column ``out``: for each of the first ``used`` bins the smallest shingle hash that fell in it.

    ``grams`` is a column of 64-bit hashes; ``bins`` is a power of two, the top bits choose
    the bin. An empty bin borrows from the bin that its own fixed random order of
    bins meets first among the filled ones: the first rounds are tables of probes, then the
    filled bin of least hashed rank. The choice depends on the bin and on which bins are filled
    only, so equal sets give equal minima and the estimate keeps its variance. The value of a
    borrowing bin is mixed with nothing else: two sets agree there when they borrow the same value.
    Without shingles the column is null.
    """
    shift = 64 - int(bins).bit_length() + 1
    bin_of = lambda x: F.shiftrightunsigned(x, shift).cast("int")
    rng = np.random.default_rng(bins)
    probes = [F.array(*[F.lit(int(x)) for x in rng.integers(0, bins, bins)]) for _ in range(PROBES)]
    df = df.withColumn("_sorted", F.sort_array(F.col(grams)))
    firsts = F.filter("_sorted", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get("_sorted", i - 1))))
    df = df.withColumn("_firsts", firsts).withColumn("_filled", F.map_from_entries(F.transform("_firsts", lambda x: F.struct(bin_of(x).alias("b"), x.alias("x")))))

    def value(b: Column) -> Column:
        nearest = F.array_min(F.transform("_firsts", lambda x: F.struct(F.xxhash64(b, bin_of(x)).alias("r"), x.alias("x"))))["x"]
        return F.coalesce(F.try_element_at("_filled", b), *[F.try_element_at("_filled", F.get(p, b)) for p in probes], nearest)

    places = F.array(*[F.lit(i) for i in range(used or bins)])
    minima = F.when(F.size("_firsts") > 0, F.transform(places, value))
    return df.withColumn(out, minima).drop("_sorted", "_firsts", "_filled")


def packed(minima: str, bits: int) -> Column:
    """The low ``bits`` (4 or 8) bits of each minimum as lower-case hex digits."""
    digits = F.array(*[F.lit(format(i, f"0{bits // 4}x")) for i in range(2**bits)])
    return F.array_join(F.transform(minima, lambda x: F.get(digits, x.bitwiseAND(F.lit(2**bits - 1)).cast("int"))), "")


def likeness(a: Column, b: Column, bins: int, bits: int) -> Column:
    """Similarity from two packed strings, freed of the share of bins that agree by chance.

    Two empty strings (no shingles) are alike, an empty and another are not.
    """
    width = bits // 4
    places = F.array(*[F.lit(1 + i * width) for i in range(bins)])
    same = F.size(F.filter(places, lambda p: F.substr(a, p, F.lit(width)) == F.substr(b, p, F.lit(width))))
    chance = 1.0 / 2**bits
    estimate = F.greatest(F.lit(0.0), (same / F.lit(float(bins)) - chance) / (1.0 - chance))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(estimate)
