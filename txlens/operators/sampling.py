"""Seeded samples by hash: the same rows under any partitioning and at any table size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash(key: str, seed: int, *more: Column) -> Column:
    """Non-negative 63-bit hash of the key, the seed and further columns."""
    return F.xxhash64(F.col(key).cast("string"), F.lit(seed), *more).bitwiseAND(F.lit((1 << 63) - 1))


def smallest_hashes(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``key`` (ties by key).

    A first pass counts rows by the bit length of their hash (at most 64 counts);
    the rows below the smallest power of two that covers ``n`` are about twice
    the sample, and they alone are ordered.
    """
    h = key_hash(key, seed)
    counts = sorted(map(tuple, df.groupBy(F.length(F.bin(h)).alias("bits")).count().collect()))
    seen, bits = 0, 63
    for b, c in counts:
        seen += c
        if seen >= n:
            bits = b
            break
    return df.where(h < F.lit((1 << bits) if bits < 63 else (1 << 63) - 1)).orderBy(h, key).limit(n)
