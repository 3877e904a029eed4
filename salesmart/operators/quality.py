"""Integrity checks of the star and the marts, each a small DataFrame of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.typing import misfits, typed
from salesmart.plans.star import DIMENSIONS, KEYS


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _row_count(name: str, frame: DataFrame) -> DataFrame:
    return frame.agg(F.count("*").cast("bigint").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count"
    )


def load_audit(star) -> DataFrame:
    """Rows per table of the star."""
    return _union(
        [
            _row_count("dim_date", star.dim_date),
            *[_row_count(f"dim_{name}", star.dim(name)) for name in DIMENSIONS],
            _row_count("fact_sales", star.sales(*KEYS.values())),
        ]
    )


def _stacked(rows: DataFrame, on: dict[str, str]) -> DataFrame:
    """(dimension, key) of several columns below each other, as text, in one scan; ``on`` maps names to columns."""
    entries = [F.struct(F.lit(n).alias("dimension"), F.col(c).cast("string").alias("key")) for n, c in on.items()]
    return rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def references(star, calendar: bool) -> DataFrame:
    """(dimension, lines, missing) of every dimension: lines, and those whose key it does not have.

    The lines are read once.  Their references are stacked and counted per dimension and key in each
    task, so a key of very many lines travels as one row, and meet the stacked keys of all dimensions
    in one join.  A null key is never found.
    """
    lines, on = star.line_references(calendar)
    known = {n: _stacked(star.dim(n), {n: c}) for n, c in on.items()}
    dims = _union(list(known.values())).where(F.col("key").isNotNull()).distinct().withColumn("known", F.lit(1))
    counted = _stacked(lines, on).groupBy("dimension", "key").agg(F.count("*").alias("lines"))
    met = counted.join(dims, ["dimension", "key"], "left")
    missing = F.sum(F.when(F.col("known").isNull(), F.col("lines")).otherwise(0))
    return met.groupBy("dimension").agg(F.sum("lines").alias("lines"), missing.alias("missing"))


def orphans(star) -> DataFrame:
    """Sale lines per dimension whose reference is not in the dimension."""
    names = star.spark.createDataFrame([(n,) for n in [*DIMENSIONS, "date"]], "dimension string")
    found = names.join(references(star, calendar=True), "dimension", "left")
    return found.select(
        F.concat(F.lit("dim_"), "dimension").alias("dimension"),
        F.coalesce("missing", F.lit(0)).cast("bigint").alias("orphans"),
    )


def lookup_audit(star) -> DataFrame:
    """One row: sale lines, and how many have no known product, store or customer."""
    found = references(star, calendar=False)

    def of(name: str, value: str):
        return F.coalesce(F.sum(F.when(F.col("dimension") == name, F.col(value))), F.lit(0)).cast("bigint")

    first = next(iter(DIMENSIONS))
    return found.agg(
        of(first, "lines").alias("line_count"), *[of(n, "missing").alias(f"missing_{n}") for n in DIMENSIONS]
    )


def returns_sign(star) -> DataFrame:
    """Return lines with a positive amount; there must be none."""
    wrong = (F.col("is_return") == 1) & (F.col("net_sales") > 0)
    return star.sales("is_return", "net_sales").agg(
        F.count_if(F.col("is_return") == 1).cast("bigint").alias("return_lines"),
        F.count_if(wrong).cast("bigint").alias("positive_returns"),
    )


def calendar_cover(star) -> DataFrame:
    """Last sale, last calendar day, and whether the calendar reaches past the sales."""
    last_sale = star.span().select("last_date").scalar()
    beyond = F.datediff("last_calendar_date", "last_sale_date").cast("bigint")
    return (
        star.dim_date.agg(F.max("date").alias("last_calendar_date"))
        .withColumn("last_sale_date", last_sale)
        .withColumn("days_beyond", beyond)
        .withColumn("is_covered", (F.col("days_beyond") > 0).cast("int"))
    )


def _unique_check(table: str, frame: DataFrame, column: str) -> DataFrame:
    """Null and surplus rows of one column.  Values are counted per key before the shuffle."""
    per_value = frame.groupBy(column).agg(F.count("*").alias("n"))
    is_null = F.col(column).isNull()
    nulls = F.sum(F.when(is_null, F.col("n")).otherwise(0))
    extra = F.sum(F.when(is_null, 0).otherwise(F.col("n") - 1))
    counted = per_value.agg(nulls.alias("nulls"), extra.alias("duplicates"))
    return counted.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.col("nulls"), F.lit(0)).cast("bigint").alias("null_count"),
        F.coalesce(F.col("duplicates"), F.lit(0)).cast("bigint").alias("duplicate_count"),
    )


def _line_checks(star) -> DataFrame:
    """Lines without a reference, and lines that share their identity, from one scan.

    The fact's key is numbered by the identity, which must be whole and unique.  Null references are
    counted with the lines of each identity, in the same partial sums.
    """
    lines, columns = star.identified_references()
    identity = star.line_id
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)]
    per_line = lines.groupBy(*[F.col(c).alias(f"id_{i}") for i, c in enumerate(identity)]).agg(
        F.count("*").alias("n"), *nulls
    )
    incomplete = reduce(lambda a, b: a | b, [F.col(f"id_{i}").isNull() for i in range(len(identity))])
    checks = [(c, F.sum(f"null_{i}"), F.lit(0)) for i, c in enumerate(columns)]
    extra = F.sum(F.when(incomplete, 0).otherwise(F.col("n") - 1))
    checks.append(("sale_key", F.sum(F.when(incomplete, F.col("n")).otherwise(0)), extra))
    counted = per_line.agg(
        *[f(value).alias(f"{kind}_{i}") for i, (_, a, b) in enumerate(checks) for kind, value, f in (("nulls", a, _or_zero), ("extra", b, _or_zero))]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{i}").alias("null_count"), F.col(f"extra_{i}").alias("duplicate_count"))
        for i, (c, _, _) in enumerate(checks)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select(F.lit("fact_sales").alias("table_name"), "r.*")


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def dimension_constraints(name: str, dim: DataFrame) -> DataFrame:
    """Key and natural id of a dimension must be present and unique."""
    columns = [c for c in [KEYS[name], DIMENSIONS[name][0]] if c in dim.columns]
    return _union([_unique_check(f"dim_{name}", dim, c) for c in columns])


def constraints(star) -> DataFrame:
    """Primary keys and natural ids unique and present; the fact's references present."""
    parts = [dimension_constraints(name, star.dim(name)) for name in DIMENSIONS]
    parts += [_unique_check("dim_date", star.dim_date, c) for c in ["date_key", "date"]]
    return _union([*parts, _line_checks(star)])


def anomaly_checks(found: DataFrame) -> DataFrame:
    """Flags are 0 or 1, directions are dip or spike, and something is flagged."""
    return found.agg(
        F.count_if(~F.col("is_anomaly").isin(0, 1)).cast("bigint").alias("bad_flags"),
        F.count_if(~F.col("direction").isin("dip", "spike")).cast("bigint").alias("bad_directions"),
        (F.sum("is_anomaly") >= 1).cast("int").alias("has_anomaly"),
    )


def forecast_checks(forecast: DataFrame, horizon: int) -> DataFrame:
    """As many future rows as the horizon, each inside its own band."""
    future = F.col("segment") == "forecast"
    outside = future & ~(
        (F.col("lower_bound") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper_bound"))
    )
    return forecast.agg(
        F.count_if(future).cast("bigint").alias("forecast_rows"),
        (F.count_if(future) == horizon).cast("int").alias("is_horizon"),
        F.count_if(outside).cast("bigint").alias("outside_band"),
    )


def type_check(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column of a text table: filled values and values its type cannot hold."""
    checks: list[Column] = []
    for column, kind in types.items():
        value = F.col(column).try_cast(kind)
        filled = F.col(column).isNotNull()
        checks += [
            F.count_if(filled).alias(f"{column}_filled"),
            F.count_if(filled & value.isNull()).alias(f"{column}_rejected"),
        ]
    counted = raw.agg(*checks)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(t).alias("column_type"),
                F.col(f"{c}_filled").cast("bigint").alias("filled"),
                F.col(f"{c}_rejected").cast("bigint").alias("rejected"),
            )
            for c, t in types.items()
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def typed_or_rejected(raw: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that cast cleanly, and the raw rows with at least one value that does not."""
    bad = misfits(types)
    return raw.where(~bad).select(*typed(types)), raw.where(bad)
