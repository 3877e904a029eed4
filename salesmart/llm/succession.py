"""Every row with the row after it in a total order, over a whole table, with one shuffle of the rows.

The order is cut into ranges at quantiles of a key; the first row of a range goes to the range before it
as well (that of the first range to the last), so every row meets its successor in its own task, and the
last row meets the first.  Ranges are sorted by Spark and read as a stream; no task holds a range.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text of a range, about, and the most ranges (ranges grow beyond).
RANGE_BYTES, MOST_RANGES = 16 << 20, 100_000
_KEY = "decimal(38,0)"


def _falling(id: str, text: str, least: int, most: int) -> Column:
    """Rises as the id falls; null ids last; rows of one id are spread by a hash of the text."""
    place = F.coalesce(F.lit(most).cast(_KEY) - F.col(id).cast(_KEY), F.lit(most - least + 1).cast(_KEY))
    spread = F.xxhash64(text).bitwiseAND(F.lit((1 << 32) - 1))
    return (place * F.lit(1 << 32).cast(_KEY) + spread.cast(_KEY)).cast(_KEY)


def _listed(values: list, kind: str) -> Column:
    """A constant array; as text it costs one literal whatever its length."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(f"array<{kind}>")


def _range_of(key: Column, cuts: list[Decimal]) -> Column:
    """How many of the sorted cuts are at most the key, by bisection."""
    if not cuts:
        return F.lit(0)
    listed, n = _listed(cuts, _KEY), len(cuts)
    steps = [F.lit(1 << s) for s in reversed(range(n.bit_length()))]

    def step(low: Column, width: Column) -> Column:
        further = low + width
        below = F.when(further <= n, F.element_at(listed, F.least(further, F.lit(n))) <= key).otherwise(False)
        return F.when(below, further).otherwise(low)

    return F.aggregate(F.array(*steps), F.lit(0), step)


def in_ranges(frame: DataFrame, id: str, text: str, range_bytes: int = RANGE_BYTES) -> DataFrame | None:
    """(id, text, part, guest): sorted ranges, id falling, each followed by the next one's first row as a guest.

    Rows equal in id go by text; the last range's guest is the first row of all.  None for an empty table.
    """
    rows = frame.select(F.col(id).alias("id"), F.col(text).alias("text"))
    sizes = rows.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min("id").alias("low"), F.max("id").alias("high")
    ).first()
    if not sizes["n"]:
        return None
    keyed = rows.withColumn("key", _falling("id", "text", sizes["low"] or 0, sizes["high"] or 0))
    parts = max(1, min(MOST_RANGES, -(-(sizes["bytes"] or 0) // range_bytes)))
    cuts: list[Decimal] = []
    if parts > 1:
        shares = _listed([i / parts for i in range(1, parts)], "double")
        found = keyed.agg(F.percentile_approx("key", shares, max(10_000, 20 * parts))).first()[0]
        cuts = sorted(set(found))
    keyed = keyed.withColumn("part", _range_of(F.col("key"), cuts))
    firsts = sorted((r["part"], r["first"]) for r in keyed.groupBy("part").agg(F.min("key").alias("first")).collect())
    first, before = [Decimal(-1)] * (len(cuts) + 1), [0] * (len(cuts) + 1)  # one entry for each range
    for i, (part, least) in enumerate(firsts):
        first[part], before[part] = least, firsts[i - 1][0]
    place = F.col("part") + 1
    as_own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    as_guest = F.struct(F.element_at(_listed(before, "int"), place).alias("part"), F.lit(1).alias("guest"))
    starts = F.col("key") == F.element_at(_listed(first, _KEY), place)
    sent = keyed.select(
        "id", "text", "key", F.explode(F.when(starts, F.array(as_own, as_guest)).otherwise(F.array(as_own))).alias("to")
    ).select("id", "text", "key", "to.part", "to.guest")
    # a range is a partition; a hash of the range would put several into one
    return sent.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "guest", "key", "text")


def successors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """(id, text, text after it) of the rows of in_ranges, in order; null texts are empty."""
    held: tuple[int | None, str] | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("id", "text", "guest")]
        for row_id, text, guest in zip(*columns, strict=True):
            text = text or ""
            if held is not None:
                yield *held, text
            # of the guests, equal ones or not, the first follows the range's last row
            held = None if guest else (row_id, text)
