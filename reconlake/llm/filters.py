"""A Bloom filter over 64-bit hashes whose size has a bound, built in Spark and tested in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS = 1 << 20
MOST_BITS = 1 << 28


class HashFilter:
    """Two bits per hash. Whatever the number of hashes, at most MOST_BITS / 8 bytes are broadcast.

    A fuller filter lets more rows through to the join behind it and changes no result.
    """

    def __init__(self, packed: np.ndarray):
        self.packed, self.mask = packed, np.uint64(len(packed) * 8 - 1)

    @classmethod
    def of(cls, hashes: DataFrame, column: str) -> HashFilter:
        """From a long column; the driver receives the bits, in bitmaps of 4,096 bytes."""
        rows = hashes.select(F.col(column).alias("h")).where("h IS NOT NULL")
        bits = LEAST_BITS
        wanted = 16 * rows.count()
        while bits < min(wanted, MOST_BITS):
            bits *= 2
        low = F.lit(bits - 1)
        probes = F.array(F.col("h").bitwiseAND(low), F.shiftrightunsigned("h", 33).bitwiseAND(low))
        bit = rows.select(F.explode(probes).alias("bit"))
        maps = bit.groupBy(F.shiftright("bit", 15).alias("part")).agg(
            F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(32767))).alias("bitmap")
        )
        packed = np.zeros(bits // 8, np.uint8)
        for part, bitmap in maps.collect():
            packed[part * 4096 : (part + 1) * 4096] = np.frombuffer(bitmap, np.uint8)
        return cls(packed)

    def might_have(self, hashes: np.ndarray) -> np.ndarray:
        found = self._set(hashes & self.mask)
        left = np.flatnonzero(found)
        found[left] = self._set((hashes[left] >> np.uint64(33)) & self.mask)
        return found

    def _set(self, probe: np.ndarray) -> np.ndarray:
        byte = self.packed[(probe >> np.uint64(3)).astype(np.int64)]
        return (byte >> (probe & np.uint64(7)).astype(np.uint8)) & 1 > 0
