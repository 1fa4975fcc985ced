"""String hashing for target encoding: XXH3, truncation masks, least collision-free bits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def xxh3(text: Column, seed: int) -> Column:
    """64-bit XXH3 of a string as a signed long. Spark has no such function, so this is the
    engine's one UDF: Arrow batches, to be applied to distinct strings only."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        import xxhash

        half, whole = 1 << 63, 1 << 64
        out = []
        for t in texts:
            if t is None:
                out.append(None)
            else:
                h = xxhash.xxh3_64_intdigest(t, seed=seed)
                out.append(h - whole if h >= half else h)
        return pd.Series(out, dtype="Int64")

    return hashed(text)


def mask_of(bits: Column) -> Column:
    """Mask of bits + 1 low bits, for 0 < bits < 64 (no overflow at either end)."""
    ones = F.lit(-1).cast("long")
    return F.call_function("shiftrightunsigned", ones, (F.lit(63) - bits).cast("int"))


def least_bits(hashes: Column) -> Column:
    """Fewest mask bits (see ``mask_of``) under which an array of hashes stays distinct."""
    first = F.greatest(F.floor(F.log2(F.size(hashes).cast("double"))).cast("int"), F.lit(1))
    fits = F.filter(
        F.sequence(first, F.lit(63)),
        lambda n: F.size(F.array_distinct(F.transform(hashes, lambda x: x.bitwiseAND(mask_of(n))))) == F.size(hashes),
    )
    return F.coalesce(F.get(fits, F.lit(0)), F.lit(63))


def mask_of_largest(value: Column) -> Column:
    """All bits up to the highest one set in ``value`` read as unsigned; 0 for 0 or null."""
    x = F.coalesce(value, F.lit(0).cast("long"))
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
    return x


def unsigned_order(value: Column) -> Column:
    """A signed long that sorts as ``value`` does unsigned."""
    return value.bitwiseXOR(F.lit(-(1 << 63)))
