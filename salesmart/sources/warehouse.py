"""Written tables: the star as versions of partitioned Parquet, marts as CSV, and reading both back."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from copy import copy
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart import schema
from salesmart.functions import bitmaps, measures
from salesmart.functions.calendar import Period, build_dim_date
from salesmart.functions.typing import as_text, column_types
from salesmart.operators import quality
from salesmart.operators.ranking import with_position, written
from salesmart.plans.star import DIMENSIONS, KEYS, ExtractStar, Star, WarehouseStar
from salesmart.settings import DEFAULTS, Settings
from salesmart.sources import snapshots
from salesmart.sources.snapshots import MONTH, Manifest

def _shaped(frame: DataFrame, struct: T.StructType) -> DataFrame:
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in struct.fields])


class LoadError(ValueError):
    """The extracts would break the star; nothing has been written to the fact."""


def together(*actions: Callable[[], object]) -> list:
    """Run independent Spark actions at the same time; the first failure is raised."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [job.result() for job in [pool.submit(action) for action in actions]]


def check_dimensions(star: ExtractStar) -> None:
    """Keys and natural ids must be unique and present, or look-ups would multiply lines."""
    checks = [quality.dimension_constraints(name, star.dim(name)) for name in DIMENSIONS]
    broken = reduce(DataFrame.unionByName, checks).where(
        "null_count > 0 OR duplicate_count > 0"
    ).collect()  # two rows per dimension at most
    if broken:
        raise LoadError(str([r.asDict() for r in broken]))


def _examples(rows: DataFrame) -> list[dict]:
    return [r.asDict() for r in rows.limit(5).collect()]


def check_lines(star: ExtractStar, rejects_path: str | None) -> None:
    """Unknown references and unreadable records stop the load, or go to ``rejects_path``.

    To stop, it is enough to know that there are any: references are counted per key and only
    the keys meet the dimensions.  Whole lines are joined only to be written or shown.
    """
    corrupt = star.extracts.corrupt
    if rejects_path:
        star.rejects().write.mode("overwrite").parquet(f"{rejects_path}/lookup")
        if corrupt is not None:
            corrupt.write.mode("overwrite").parquet(f"{rejects_path}/corrupt")
        return
    audit = quality.lookup_audit(star).first().asDict()
    missing = {k: v for k, v in audit.items() if k.startswith("missing_") and v}
    if missing:
        raise LoadError(f"lookup: {missing}, such as {_examples(star.rejects())}")
    if corrupt is not None and not corrupt.isEmpty():
        raise LoadError(f"corrupt: {_examples(corrupt)}")


def _month(date_key: Column) -> Column:
    return F.floor(date_key / 100).cast("int").alias(MONTH)


def _write_months(star: Star, fact: DataFrame, path: str, commit_id: str) -> list[int]:
    """Write the fact by month, then what is kept per month from the written lines; returns the months."""
    fact = _shaped(fact, schema.FACT_SALES).withColumn(MONTH, _month(F.col("date_key")))
    months = snapshots.write_months(fact, path, "fact_sales", commit_id)
    lines = _lines_of(star, path, commit_id, months)
    totals = lines.groupBy(MONTH, "date_key", "store_key").agg(*[measures.partial(b) for b in measures.SUMS])
    customer = F.col("customer_key")
    customers = lines.groupBy(MONTH, bitmaps.word_of(customer).alias(bitmaps.WORD)).agg(
        bitmaps.merged(bitmaps.bit_of(customer)).alias(bitmaps.BITS)
    )
    for name, frame in (("day_totals", totals), ("month_customers", customers)):
        struct = schema.MONTHLY_TABLES[name]
        # a month's rows go to one file each, not to one for every task
        shaped = frame.select(*[F.col(f.name).cast(f.dataType) for f in struct.fields], MONTH).repartition(MONTH)
        snapshots.write_months(shaped, path, name, commit_id)
    return months


def _lines_of(star: Star, path: str, commit_id: str, months: list[int]) -> DataFrame:
    own = Manifest(0, {}, {"fact_sales": dict.fromkeys(months, commit_id)}, {})
    return snapshots.read_months(star.spark, path, "fact_sales", schema.FACT_SALES, own)


def _top_keys(star: Star, path: str, commit_id: str, months: list[int]) -> dict[int, int]:
    tops = _lines_of(star, path, commit_id, months).groupBy(MONTH).agg(F.max("sale_key").alias("top"))
    return {r[MONTH]: r["top"] for r in tops.collect()}  # one row per month


def write_star(star: ExtractStar, path: str, rejects_path: str | None = None) -> WarehouseStar:
    """Full refresh of the five tables and of what is kept from them, as a new version.

    Without ``rejects_path`` a line with an unknown reference stops the load; with it, such
    lines are written there and the rest is loaded.  Readers see the version before until
    everything is written.
    """
    together(lambda: check_dimensions(star), lambda: check_lines(star, rejects_path))
    loaded = star.accepted() if rejects_path else star
    before, commit_id = snapshots.latest_or_empty(star.spark, path), snapshots.new_commit()

    def write_dim(name: str) -> None:
        snapshots.write_table(_shaped(getattr(loaded, name), schema.STAR_TABLES[name]), path, name, commit_id)

    months, *_ = together(
        lambda: _write_months(loaded, loaded.fact_sales(), path, commit_id),
        lambda: write_dim("dim_date"),
        *[partial(write_dim, f"dim_{n}") for n in DIMENSIONS],
    )
    found = Manifest(
        before.version,
        dict.fromkeys(["dim_date", *[f"dim_{n}" for n in DIMENSIONS]], commit_id),
        {name: dict.fromkeys(months, commit_id) for name in schema.MONTHLY_TABLES},
        _top_keys(star, path, commit_id, months),
    )
    return _star_of(star.spark, path, snapshots.commit(star.spark, path, found), star.settings)


def _star_of(spark: SparkSession, path: str, manifest: Manifest, settings: Settings) -> WarehouseStar:
    tables = {n: snapshots.read_table(spark, path, n, schema.STAR_TABLES[n], manifest) for n in manifest.tables}
    tables |= {n: snapshots.read_months(spark, path, n, s, manifest) for n, s in schema.MONTHLY_TABLES.items()}
    return WarehouseStar(spark, tables, settings)


def read_star(
    spark: SparkSession, path: str, settings: Settings = DEFAULTS, version: int | None = None
) -> WarehouseStar:
    """The latest version or an earlier one; the star stays that version whatever is written later."""
    return _star_of(spark, path, snapshots.read_manifest(spark, path, version), settings)


def _months(period: Period) -> list[int]:
    first = period.first.year * 12 + period.first.month - 1
    last = period.last.year * 12 + period.last.month - 1
    return [m // 12 * 100 + m % 12 + 1 for m in range(first, last + 1)]


def _whole_months(period: Period) -> Period:
    after = (period.last.replace(day=28) + datetime.timedelta(days=4)).replace(day=1)
    return Period(period.first.replace(day=1), after - datetime.timedelta(days=1))


def _kept_keys(star: ExtractStar, old: WarehouseStar, name: str) -> DataFrame:
    """The dimension after a refresh: known ids keep their keys, new ones follow the highest key.

    A row of the new master replaces the old one; members that the master no longer has stay,
    since kept lines may refer to them.
    """
    key, natural_id = KEYS[name], DIMENSIONS[name][0]
    struct = schema.STAR_TABLES[f"dim_{name}"]
    before, master = old.dim(name), getattr(star.extracts, f"{name}s")()
    if key not in master.columns:
        known = before.select(natural_id, key)
        top = before.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]  # one row
        fresh = with_position(master.join(known, natural_id, "left_anti"), [F.asc(natural_id)], key)
        master = master.join(known, natural_id).unionByName(
            fresh.withColumn(key, F.col(key) + F.lit(top))
        )
    gone = before.join(master.select(natural_id), natural_id, "left_anti")
    return written(_shaped(master, struct).unionByName(_shaped(gone, struct)))


def refresh(star: ExtractStar, path: str, period: Period) -> list[int]:
    """Replace the months a period touches with the extract's lines, and renew dimensions and calendar.

    Ids keep the keys that they have in the warehouse, so kept and new lines mean the same by a
    key.  Checks run before anything is written.  Dimensions, calendar, the touched months and the
    totals of these are written beside the old files; the manifest, written last, puts them all in
    force at once.  Months outside the period are neither read nor written.  New lines get keys
    above every kept key; they stay unique and rise with the date inside the refresh.  A month
    without lines in the extract is empty afterwards.  Returns the replaced months.
    """
    before, commit_id = snapshots.read_manifest(star.spark, path), snapshots.new_commit()
    tables = {n: snapshots.read_table(star.spark, path, n, schema.STAR_TABLES[n], before) for n in before.tables}
    old = WarehouseStar(star.spark, tables, star.settings)  # dimensions and calendar; no line is read
    star = copy(star)
    for name in DIMENSIONS:
        setattr(star, f"dim_{name}", _kept_keys(star, old, name))
    together(lambda: check_dimensions(star), lambda: check_lines(star, None))
    days = old.dim_date.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    days = days.select("first_date", F.date_sub("last_date", star.settings.horizon_days).alias("last_date"))
    spans = days.unionByName(star.span())
    span = spans.agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
    calendar = _shaped(build_dim_date(span, star.settings.horizon_days), schema.STAR_TABLES["dim_date"])
    tables = {f"dim_{name}": star.dim(name) for name in DIMENSIONS} | {"dim_date": calendar}
    together(*[partial(snapshots.write_table, f, path, t, commit_id) for t, f in tables.items()])
    period = _whole_months(period)
    touched = _months(period)
    kept_tops = {m: top for m, top in before.top_keys.items() if m not in touched}
    lines = star.fact_sales(period, max(kept_tops.values(), default=0))
    filled = _write_months(star, lines, path, commit_id)
    months = {
        name: {m: c for m, c in before.months.get(name, {}).items() if m not in touched} | dict.fromkeys(filled, commit_id)
        for name in schema.MONTHLY_TABLES
    }
    tops = kept_tops | _top_keys(star, path, commit_id, filled)
    snapshots.commit(star.spark, path, Manifest(before.version, dict.fromkeys(tables, commit_id), months, tops))
    return touched


def export_csv(frame: DataFrame, path: str) -> None:
    """One folder of CSV files with headers per table."""
    frame.write.mode("overwrite").option("header", True).csv(path)


def export_marts(star: WarehouseStar, path: str) -> None:
    """The star's tables as CSV."""

    def export(name: str) -> None:
        export_csv(star.tables[name].select(*schema.STAR_TABLES[name].names), f"{path}/{name}")

    together(*[partial(export, name) for name in schema.STAR_TABLES])


def read_mart(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A CSV mart with its declared types, and the rows that do not fit them."""
    struct = {**schema.STAR_TABLES, **schema.MART_TABLES}[name]
    raw = spark.read.schema(as_text(struct)).option("header", True).csv(f"{path}/{name}")
    return quality.typed_or_rejected(raw, column_types(struct))


def table_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows per written table, from file statistics."""
    return {name: frame.count() for name, frame in tables.items()}
