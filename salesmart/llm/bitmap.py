"""Sets of hashes as a bitmap of bounded size, to leave out early what an exact step would drop later.

A member is always found; a hash that is no member is found by chance as often as the bitmap is filled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the largest bitmap (32 MB); above 30 million members it merely lets more through.
MOST_BITS = 1 << 28
#: Bits for each member, and the least bits.
BITS_EACH, LEAST_BITS = 16, 1 << 18
#: Bits of one bitmap of the SQL functions.
_CHUNK = 1 << 15


def bits_for(members: int) -> int:
    """A power of two, so that a hash is cut to its lower bits."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (members * BITS_EACH - 1).bit_length() if members else 0))


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a column of longs, built by tasks; at most MOST_BITS / 8 bytes come to the driver."""
    bits = bits_for(hashes.count())
    place: Column = F.col(column).bitwiseAND(F.lit(bits - 1))
    parts = (
        hashes.select(place.alias("bit"))
        .groupBy(F.shiftright("bit", 15).alias("chunk"))
        .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(_CHUNK - 1))).alias("bits"))
    )
    out = np.zeros((bits // _CHUNK, _CHUNK // 8), np.uint8)
    for row in parts.collect():
        out[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def found(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be a member."""
    place = hashes.view(np.uint64) & np.uint64(8 * len(bits) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0
