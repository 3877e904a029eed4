"""Exact distinct counts that merge: a set of whole-number keys as rows of (word, 64 bits).

Sets of parts become the set of the whole by one OR per word, at any grain and in any order, where a
distinct count would need every key again.  The OR of a long is a plain hash aggregate with partial
results; the built-in 32,768-bit aggregate sorts all its input, since its buffer has no fixed place.
Any long is a key; the denser the keys, the fewer the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns of a set.
WORD, BITS = "word", "bits"


def word_of(key: Column) -> Column:
    """Which row holds a key; null for a null key."""
    return F.shiftright(key.cast("bigint"), 6)


def bit_of(key: Column) -> Column:
    """The key's bit within its row."""
    place = key.cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def merged(bits: Column) -> Column:
    """Aggregate: the union of sets, per word."""
    return F.bit_or(bits)


def members(bits: Column) -> Column:
    """Aggregate: how many keys a set has, over all its words; null keys count for nothing."""
    return F.coalesce(F.sum(F.bit_count(bits)), F.lit(0)).cast("bigint")
