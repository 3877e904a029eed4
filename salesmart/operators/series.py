"""Daily totals and gap-free daily series, per entity or overall."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from salesmart.functions.measures import final, merged
from salesmart.functions.rounding import money_sum
from salesmart.operators.lookup import attach

#: Which rows to give back, of their values, medians and spreads; a missing one is NaN.
Keep = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
#: Windows that are sorted at a time.
WINDOWS = 1 << 14
#: Filled days of many entities that are measured at a time.
DAYS = 1 << 17
#: In place of a missing date; it comes first.
NO_DAY = -(1 << 40)
#: Columns that tell the members of a dimension apart.
MEMBER_KEYS = {"product_key", "store_key", "customer_key"}


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def daily_sales(star) -> DataFrame:
    """Net sales per day with sales."""
    return daily_by(star, [])


def daily_by(star, by: list[str]) -> DataFrame:
    """Net sales per day and any keys or attributes of the star, from its day totals where it has them.

    A member's key and a day have few lines each, so lines are dealt by both first.  Summing them
    before that shuffle would save few rows, and its hash table, as large as a task's lines, would
    outgrow memory.  Attributes have few values; their lines are summed before the shuffle.
    """
    totals = star.day_totals(by, ["net"])
    if totals is not None:
        return totals.groupBy("date", *by).agg(merged("net")).select("date", *by, final("net").alias("net_sales"))
    lines = star.sales("date", *by, "net_sales")
    if MEMBER_KEYS & {*by}:
        lines = lines.repartition("date", *by)
    return lines.groupBy("date", *by).agg(
        money_sum(F.col("net_sales")).alias("net_sales")
    )


def store_daily(star) -> DataFrame:
    """Net sales per store and day; lines are summed by key before the names are looked up."""
    totals = daily_by(star, ["store_key"])
    names = star.dim_store.select("store_key", "store_id", "store_name", "region")
    return attach(totals, names, "store_key").drop("store_key")


def dense_daily(
    daily: DataFrame, entity: list[str], span: DataFrame, value: str = "net_sales"
) -> DataFrame:
    """Fill the missing days of every entity with 0, over the whole ``span`` of all entities.

    Each row is exploded over the gap behind it, and an entity's first row also over the gap
    before it.  This takes one shuffle by entity and no join with a calendar.
    """
    first_day = span.select("first_date").scalar()
    last_day = span.select("last_date").scalar()
    if entity:
        # a fixed partition count: adaptive execution would merge these partitions by their
        # size before the days are filled in, and leave few tasks for many filled rows
        daily = daily.repartition(_partitions(daily), *entity)
    by_date = Window.partitionBy(*entity).orderBy("date")
    start = F.when(F.row_number().over(by_date) == 1, first_day).otherwise(F.col("date"))
    following = F.lead("date").over(by_date)
    gaps = daily.select(
        *entity,
        "date",
        value,
        start.alias("_from"),
        F.coalesce(F.date_sub(following, 1), last_day).alias("_to"),
    )
    days = gaps.select(
        *entity, "date", value, F.explode(F.sequence("_from", "_to")).alias("_day")
    )
    return days.select(
        *entity,
        F.col("_day").alias("date"),
        F.when(F.col("_day") == F.col("date"), F.col(value)).otherwise(0.0).alias(value),
    )


def rolling_median(values: np.ndarray, rows: int, min_periods: int, lag: int = 0) -> np.ndarray:
    """Median of the last ``rows`` values of each place, blank (NaN) while fewer than ``min_periods`` are there.

    With ``lag`` the window ends so many places before its own.  Counts tell where zeros hold the
    middle of a window, as in long gaps; the other windows are sorted, a block at a time.
    """
    n = len(values)
    padded = np.concatenate([np.full(rows - 1 + lag, np.nan), values])[: n + rows - 1]

    def of_windows(hit: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(hit)])
        return upto[rows:] - upto[:-rows]

    count, below, zeros = of_windows(~np.isnan(padded)), of_windows(padded < 0), of_windows(padded == 0)
    low, high = np.maximum(count - 1, 0) // 2, np.minimum(count // 2, rows - 1)
    enough = count >= min_periods
    found = np.where(enough, 0.0, np.nan)
    other = np.flatnonzero(enough & ((below > low) | (high >= below + zeros)))
    windows = sliding_window_view(padded, rows)
    for start in range(0, len(other), WINDOWS):
        part = other[start : start + WINDOWS]
        ordered, at = np.sort(windows[part], axis=1), np.arange(len(part))  # blanks last
        found[part] = (ordered[at, low[part]] + ordered[at, high[part]]) / 2
    return found


def filled_days(
    days: np.ndarray, values: np.ndarray, heads: np.ndarray, first: int, last: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``dense_daily`` in arrays: every day from ``first`` to ``last``, 0 where there is no row.

    An entity's rows begin at its place in ``heads``; its days are whole numbers in rising order,
    where NO_DAY comes first and is no day's value.  Gives the entity's number, day and value.
    """
    entity = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(days))))
    start, end = days.copy(), np.append(days[1:] - 1, last)
    start[heads] = first
    end[heads[1:] - 1] = last
    sizes = np.abs(end - start) + 1
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    day = np.repeat(start, sizes) + place * np.repeat(np.where(end < start, -1, 1), sizes)
    value = np.where(day == np.repeat(days, sizes), np.repeat(values, sizes), 0.0)
    entity = np.repeat(entity, sizes)
    if np.any((np.diff(day) < 0) & (np.diff(entity) == 0)):
        order = np.lexsort((day, entity))
        day, value = day[order], value[order]
    return entity, day, value


def rolling_spread(
    values: np.ndarray, entity: np.ndarray, rows: int, min_periods: int, lag: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rolling median, and rolling median of the distances from it, of each run of an entity's number."""
    at = np.arange(len(values)) + entity * (rows - 1 + lag)  # blanks between, so that no window meets two
    spaced = np.full(at[-1] + 1 if len(at) else 0, np.nan)
    spaced[at] = values
    centre = rolling_median(spaced, rows, min_periods, lag)
    return centre[at], rolling_median(np.abs(spaced - centre), rows, min_periods, lag)[at]


def _heads(table: pa.Table, entity: list[str]) -> np.ndarray:
    """The rows at which another entity begins; nulls are alike, and so are NaNs."""
    new = np.arange(len(table)) == 0
    for name in entity:
        column = table.column(name).combine_chunks()
        blank = column.is_null(nan_is_null=True)
        differs = pc.fill_null(pc.not_equal(column[1:], column[:-1]), False).to_numpy(zero_copy_only=False)
        null, nan = (x.to_numpy(zero_copy_only=False) for x in (column.is_null(), blank))
        new[1:] |= (differs & ~(nan[1:] & nan[:-1])) | (null[1:] != null[:-1])
    return np.flatnonzero(new)


def _whole_entities(batches: Iterable[pa.RecordBatch], entity: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of rows sorted by entity, dealt anew so that all rows of an entity are in one; the heads of each."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # the row before tells whether the batch goes on with its entity
        seam = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch] if held else [batch])
        heads = _heads(seam, entity)[1:] - (1 if held else 0)
        if len(heads):
            table = pa.Table.from_batches([*held, batch.slice(0, heads[-1])])
            yield table, _heads(table, entity)
            held = []
        held.append(batch.slice(heads[-1] if len(heads) else 0))
    if held:
        table = pa.Table.from_batches(held)
        yield table, _heads(table, entity)


def with_rolling_spread(
    df: DataFrame, value: str, middle: str, spread: str, entity: list[str], rows: int, min_periods: int, lag: int = 0,
    span: DataFrame | None = None, keep: Keep | None = None,
) -> DataFrame:
    """Rolling median of a value, and rolling median of its distance from the median of its own day.

    The sorted windows are arrays of numbers in a task, which takes a small part of the time of
    collecting and sorting them as window frames.  Without ``span`` each entity is a group.

    With ``span`` the rows are those of days with a value only, and the missing days are filled
    with 0 in the task, as ``dense_daily`` does: only what is there is shuffled and sorted.  A
    task reads its entities one after the other and takes many at a time, bounded by their days.
    With ``keep`` all days are filled and measured, and those that it picks leave the task.
    """
    window = (rows, min_periods, lag)
    added = [StructField(n, DoubleType()) for n in (middle, spread)]

    def measured(table: pa.Table, values: np.ndarray, number: np.ndarray) -> pa.Table:
        found = rolling_spread(values, number, *window)
        if keep is not None:
            kept = np.flatnonzero(keep(values, *found))
            table, found = table.take(pa.array(kept)), [f[kept] for f in found]
        for name, column in zip((middle, spread), found, strict=True):
            table = table.append_column(name, pa.array(column, pa.float64(), from_pandas=True))
        return table

    if span is None:

        def measure(table: pa.Table) -> pa.Table:
            table = table.take(pc.sort_indices(table, sort_keys=[("date", "ascending")], null_placement="at_start"))
            values = table.column(value).to_numpy().astype(np.float64)
            return measured(table, values, np.zeros(len(values), np.int64))

        return df.groupBy(*entity).applyInArrow(measure, StructType([*df.schema.fields, *added]))

    def filled(table: pa.Table, heads: np.ndarray, first: int, last: int) -> pa.Table:
        days = pc.fill_null(table.column("date").cast(pa.int32()).cast(pa.int64()), NO_DAY).to_numpy()
        order = np.lexsort((days, np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(days))))))
        there = table.column(value).to_numpy().astype(np.float64)
        number, day, values = filled_days(days[order], there[order], heads, first, last)
        kept = {"number": pa.array(number), "date": pa.array(day.astype(np.int32)).cast(pa.date32())}
        found = measured(pa.table(kept | {value: pa.array(values, from_pandas=True)}), values, number)
        names = table.select(entity).take(pa.array(heads)).take(found.column("number"))
        columns = [*names.columns, *found.drop_columns("number").columns]
        return pa.table(columns, names=[*entity, "date", value, middle, spread])

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, heads in _whole_entities(batches, entity):
            first, last = (table.column(c).cast(pa.int32())[0].as_py() for c in ("_first", "_last"))
            if first is None:  # no row has a date
                continue
            step = max(1, DAYS // (last - first + 1))
            for at in range(0, len(heads), step):
                end = heads[at + step] if at + step < len(heads) else len(table)
                part = table.slice(heads[at], end - heads[at])
                yield from filled(part, heads[at : at + step] - heads[at], first, last).to_batches()

    day = [span.select(f"{n}_date").scalar().alias(f"_{n}") for n in ("first", "last")]
    rows_of = df.select(*entity, "date", F.col(value).cast("double").alias(value))
    schema = StructType([*rows_of.schema.fields, *added])
    # a fixed partition count, for the reason given in dense_daily
    dealt = rows_of.repartition(_partitions(df), *entity) if entity else rows_of.repartition(1)
    return (dealt.sortWithinPartitions(*entity) if entity else dealt).select("*", *day).mapInArrow(fill, schema)
