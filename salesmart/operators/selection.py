"""Exact values at given ranks of several orders at once, and tiles from them, without sorting the table.

Every order is a whole-number column, ties by a unique whole-number key.  The rank of a border is known from
the number of rows; its row is found by histograms: one scan counts the rows of every order in cells of the
range that still holds a border, the cell in which the border's rank falls is the next range.  A range of one
value goes on with the key.  When the ranges together hold few rows, these alone come to the driver.  So each
round is a scan with partial sums and a result of bounded size, and the number of rounds depends on the width
of the values, not on the rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of a range in one round, and rows that all ranges may hold before they are read.
CELLS, LEAF_ROWS = 1024, 50_000
#: A row without a key comes first of its value.
NO_KEY = -(1 << 63)


@dataclass(frozen=True)
class Range:
    """Rows of an order between two values or, within one value, between two keys; ``below`` precede them."""

    low: int
    high: int
    below: int
    rows: int
    value: int | None = None  # the one value, if low and high are keys

    def holds(self, value: Column, key: Column) -> Column:
        if self.value is None:
            return value.between(self.low, self.high)
        return (value == self.value) & key.between(self.low, self.high)

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // CELLS)

    def cell(self, value: Column, key: Column) -> Column:
        # a wide range exceeds a long; decimals hold any difference of longs
        distance = (key if self.value is not None else value).cast("decimal(20,0)") - F.lit(self.low).cast("decimal(20,0)")
        return F.call_function("div", distance, F.lit(self.width).cast("decimal(20,0)"))


def borders_at(rows: DataFrame, orders: list[str], key: str, ranks: dict[str, list[int]], bounds: dict[str, tuple]) -> dict[str, list[tuple[int, int]]]:
    """(value, key) of the rows at these 1-based ranks of each order; bounds has (least, greatest, rows)."""
    key_bounds = bounds[key]
    ranges = {o: {r: Range(bounds[o][0], bounds[o][1], 0, bounds[o][2]) for r in ranks[o]} for o in orders}

    def distinct(order: str) -> list[Range]:
        return sorted(set(ranges[order].values()), key=lambda r: (r.below, r.rows))

    def one_value(found: Range) -> Range:
        if found.value is None and found.low == found.high:
            return Range(key_bounds[0], key_bounds[1], found.below, found.rows, found.low)
        return found

    while sum(r.rows for o in orders for r in distinct(o)) > LEAF_ROWS:
        if any(r.value is not None and r.low == r.high and r.rows > 1 for o in orders for r in distinct(o)):
            raise ValueError(f"{key} is not unique")
        ranges = {o: {rank: one_value(r) for rank, r in of.items()} for o, of in ranges.items()}
        counts = defaultdict(dict)
        for row in _histogram(rows, {o: distinct(o) for o in orders}, key).collect():  # CELLS for each range
            counts[row["order"], row["which"]][row["cell"]] = row["n"]
        ranges = {
            o: {rank: _narrowed(r, rank, counts[i, distinct(o).index(r)]) for rank, r in ranges[o].items()}
            for i, o in enumerate(orders)
        }
    found: dict[str, list] = defaultdict(list)
    for row in _leaves(rows, {o: distinct(o) for o in orders}, key).collect():  # LEAF_ROWS at most
        found[row["order"], row["which"]].append((row["value"], row["key"]))
    leaves = {k: sorted(v) for k, v in found.items()}
    return {
        o: [leaves[i, distinct(o).index(ranges[o][r])][r - ranges[o][r].below - 1] for r in ranks[o]]
        for i, o in enumerate(orders)
    }


def _narrowed(found: Range, rank: int, cells: dict[int, int]) -> Range:
    below = found.below
    for cell in sorted(cells):
        if below + cells[cell] >= rank:
            low = found.low + cell * found.width
            return Range(low, min(found.high, low + found.width - 1), below, cells[cell], found.value)
        below += cells[cell]
    raise AssertionError("a rank beyond the rows")


def _placed(rows: DataFrame, ranges: dict[str, list[Range]], key: str, shape) -> DataFrame:
    """One row per row and range that holds it: order, which, and what ``shape`` makes of it."""
    entries = []
    for i, (order, of) in enumerate(ranges.items()):
        for which, found in enumerate(of):
            value = F.struct(F.lit(i).alias("order"), F.lit(which).alias("which"), *shape(found, F.col(order), F.col(key)))
            entries.append(F.when(found.holds(F.col(order), F.col(key)), value))
    return rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def _histogram(rows: DataFrame, ranges: dict[str, list[Range]], key: str) -> DataFrame:
    placed = _placed(rows, ranges, key, lambda r, value, of: [r.cell(value, of).alias("cell")])
    return placed.groupBy("order", "which", "cell").agg(F.count("*").alias("n"))


def _leaves(rows: DataFrame, ranges: dict[str, list[Range]], key: str) -> DataFrame:
    return _placed(rows, ranges, key, lambda r, value, of: [value.alias("value"), of.alias("key")])


def tile_ends(rows: int, tiles: int) -> list[int]:
    """The last rank of every NTILE bucket but the last; the first ``rows % tiles`` buckets hold one row more."""
    size, larger = divmod(rows, tiles)
    return [t * size + min(t, larger) for t in range(1, tiles) if t * size + min(t, larger) < rows]


def add_tiles(df: DataFrame, orders: dict[str, Column], key: str, tiles: int) -> DataFrame:
    """NTILE buckets of several orders, each rising by its whole-number column and then the unique key.

    ``df`` should be cheap to read again, such as a written table: it is scanned three times and a few
    more where values spread widely, each time over these columns only.
    """
    names = {name: f"_order_{i}" for i, name in enumerate(orders)}
    unique = F.coalesce(F.col(key).cast("bigint"), F.lit(NO_KEY))
    rows = df.select(unique.alias("_key"), *[c.cast("bigint").alias(names[n]) for n, c in orders.items()])
    columns = ["_key", *names.values()]
    first = rows.agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}{c}") for c in columns for f in (F.min, F.max)]).first()
    ends = tile_ends(first["n"], tiles)
    borders: dict[str, list] = dict.fromkeys(names.values(), [])
    if ends:
        bounds = {c: (first[f"min{c}"], first[f"max{c}"], first["n"]) for c in columns}
        borders = borders_at(rows, list(names.values()), "_key", dict.fromkeys(names.values(), ends), bounds)
    return df.withColumns({n: _tile(orders[n].cast("bigint"), unique, borders[c]) for n, c in names.items()})


def _tile(value: Column, key: Column, borders: Iterable[tuple[int, int]]) -> Column:
    """One more than the borders that a row lies beyond."""
    beyond = [((value > v) | ((value == v) & (key > k))).cast("int") for v, k in borders]
    return sum(beyond, F.lit(1)).cast("int")
