"""Filters over 64-bit hashes: which values of a large side can have a partner at all."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each value, hashes of each, and the least and largest size as powers of two.
PER_VALUE, HASHES, FEWEST, MOST = 16, 3, 16, 30
_PAGE = 32_768


class HashFilter:
    """A Bloom filter; it may say yes to one in 150 of the values that it doesn't hold, never no to one that it holds."""

    def __init__(self, bits: int, bitmap: bytes) -> None:
        self.bits, self.bitmap = bits, bitmap

    @staticmethod
    def made(values: DataFrame) -> HashFilter:
        """The filter of ``values(h long)``, built in the executors and fetched by pages of 4 KB.

        It takes 16 bits a value, from ``2**16`` up to ``2**30`` bits: 128 MB at most, the full rate up to 67 million values.
        """
        bits = 1 << min(MOST, max(FEWEST, (values.count() * PER_VALUE).bit_length()))
        first, second = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32)
        at = values.select(F.explode(F.array(*((first + second * k).bitwiseAND(F.lit(bits - 1)) for k in range(HASHES)))).alias("p"))
        pages = at.groupBy(F.floor(F.col("p") / _PAGE).cast("int").alias("page")).agg(F.bitmap_construct_agg(F.col("p") % _PAGE).alias("b"))
        bitmap = bytearray(bits // 8)
        for row in pages.toLocalIterator():
            at_byte = row["page"] * _PAGE // 8
            bitmap[at_byte : at_byte + _PAGE // 8] = row["b"][: bits // 8 - at_byte]
        return HashFilter(bits, bytes(bitmap))

    def __contains__(self, h: int) -> bool:
        first, second = h & 0xFFFFFFFF, h >> 32 & 0xFFFFFFFF
        return all(self.bitmap[(p := (first + second * k) & (self.bits - 1)) >> 3] >> (p & 7) & 1 for k in range(HASHES))

    def mask(self, h: np.ndarray) -> np.ndarray:
        """Which of many unsigned hashes it may hold."""
        bitmap = np.frombuffer(self.bitmap, np.uint8)
        first, second = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
        out = np.ones(len(h), bool)
        for k in range(HASHES):
            p = (first + second * np.uint64(k)) & np.uint64(self.bits - 1)
            out &= (bitmap[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out
