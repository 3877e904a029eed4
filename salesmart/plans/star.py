"""The star schema as DataFrames: dimensions, and sale lines pruned to what a query asks for."""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions import bitmaps
from salesmart.functions.calendar import CALENDAR, Period, build_dim_date, date_of_key
from salesmart.functions.sale_line import INPUTS, LINE_MEASURES
from salesmart.operators.lookup import attach, fits_broadcast
from salesmart.operators.numbering import number_lines
from salesmart.operators.ranking import with_surrogate_key
from salesmart.schema import FACT_SALES
from salesmart.settings import DEFAULTS, Settings
from salesmart.sources.extracts import Extracts

PRODUCT = ["product_id", "product_name", "category", "subcategory", "brand", "list_price", "unit_cost"]
STORE = ["store_id", "store_name", "region", "store_type", "open_date"]
CUSTOMER = ["customer_id", "gender", "age_band", "loyalty_tier", "signup_date"]
DIMENSIONS = {"product": PRODUCT, "store": STORE, "customer": CUSTOMER}
KEYS = {"product": "product_key", "store": "store_key", "customer": "customer_key"}


def _column(name: str, derived: dict) -> Column:
    if name in derived:
        return derived[name]()
    return CALENDAR[name](F.col("date")) if name in CALENDAR else F.col(name)


class Star:
    """Base of the two stars; a subclass says where dimensions and sale lines come from."""

    def __init__(self, spark: SparkSession, settings: Settings = DEFAULTS):
        self.spark = spark
        self.settings = settings

    def with_settings(self, **changes) -> Star:
        """The same star under other settings."""
        same = copy(self)
        same.settings = replace(self.settings, **changes)
        return same

    def _build_dim(self, name: str) -> DataFrame:
        raise NotImplementedError

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._build_dim("product")

    @cached_property
    def dim_store(self) -> DataFrame:
        return self._build_dim("store")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._build_dim("customer")

    def dim(self, name: str) -> DataFrame:
        return getattr(self, f"dim_{name}")

    @property
    def dim_date(self) -> DataFrame:
        return build_dim_date(self.span(), self.settings.horizon_days)

    def calendar_end(self) -> DataFrame:
        """One row, one column: the last day of the date dimension."""
        last = F.date_add("last_date", self.settings.horizon_days)
        return self.span().select(last.alias("last_date"))

    @property
    def line_id(self) -> list[str]:
        """Columns that together identify a sale line."""
        raise NotImplementedError

    def line_references(self, calendar: bool) -> tuple[DataFrame, dict[str, str]]:
        """The lines' references to all dimensions before any look-up, in one scan; the column of each.

        With ``calendar`` also their day, of the dimension "date".
        """
        on = dict(KEYS) | ({"date": "date_key"} if calendar else {})
        return self.sales(*on.values()), on

    def identified_references(self) -> tuple[DataFrame, list[str]]:
        """The lines' references and day with their identity, in one scan; the columns that refer."""
        lines, on = self.line_references(True)
        return self.sales(*dict.fromkeys([*on.values(), *self.line_id])), list(on.values())

    def fact_sales(self) -> DataFrame:
        raise NotImplementedError

    def tables_by_name(self) -> dict[str, DataFrame]:
        dims = {f"dim_{name}": self.dim(name) for name in DIMENSIONS}
        return {"dim_date": self.dim_date, **dims, "fact_sales": self.fact_sales()}

    def register_views(self, prefix: str = "") -> None:
        """Make the five tables available to ``spark.sql`` under their own names."""
        for name, frame in self.tables_by_name().items():
            frame.createOrReplaceTempView(f"{prefix}{name}")

    def sales(self, *columns: str, during: Period | None = None) -> DataFrame:
        """One row per sale line with exactly ``columns``, optionally of a period of days.

        A column may be a fact column, a key, an attribute of the product, store or customer,
        or any calendar attribute.  Only the look-ups that the columns need are joined, and
        calendar attributes are computed from the date instead of being joined.  References
        that a query does not look up are not checked here; the load checks them all.
        """
        raise NotImplementedError

    def day_totals(self, columns: list[str], bases: list[str], during: Period | None = None) -> DataFrame | None:
        """Kept sums (in cents) per day and store with ``columns``; None where only lines can tell."""
        return None

    def month_customers(self) -> DataFrame:
        """(month_idx, word, bits): who bought in each month, as sets of customer keys."""
        customer = F.col("customer_key")
        months = self.sales("date", "customer_key").groupBy(
            CALENDAR["month_idx"](F.col("date")).alias("month_idx"), bitmaps.word_of(customer).alias(bitmaps.WORD)
        )
        return months.agg(bitmaps.merged(bitmaps.bit_of(customer)).alias(bitmaps.BITS))

    def span(self) -> DataFrame:
        """One row: first and last date of the sale lines."""
        return self.sales("date").agg(
            F.min("date").alias("first_date"), F.max("date").alias("last_date")
        )


class ExtractStar(Star):
    """A star derived from source extracts on the fly."""

    def __init__(
        self,
        spark: SparkSession,
        extracts: Extracts,
        settings: Settings = DEFAULTS,
    ):
        super().__init__(spark, settings)
        self.extracts = extracts
        self.only_accepted = False

    def _build_dim(self, name: str) -> DataFrame:
        """The master with its key first; a master that brings no key is numbered by its id."""
        master = getattr(self.extracts, f"{name}s")()
        key, natural_id = KEYS[name], DIMENSIONS[name][0]
        if key in master.columns:
            return master
        return with_surrogate_key(master, key, natural_id)

    def _raw_lines(self, needed: set[str], how: str) -> DataFrame:
        """Raw sale lines plus the dimension columns in ``needed``, one join per dimension."""
        at_list = "unit_price" in needed and not self.extracts.has_price
        if at_list:
            needed = needed - {"unit_price"} | {"list_price"}
        wanted = {
            name: [c for c in [KEYS[name], *DIMENSIONS[name]] if c in needed]
            for name in DIMENSIONS
        }
        if self.only_accepted:
            wanted = {n: cols or [KEYS[n]] for n, cols in wanted.items()}
        lines = self.extracts.lines(needed | {KEYS[n] for n, cols in wanted.items() if cols})
        for name, cols in wanted.items():
            if not cols:
                continue
            key, natural_id = KEYS[name], DIMENSIONS[name][0]
            on = key if key in lines.columns else natural_id
            extra = [c for c in cols if c != on]
            if extra or how != "inner" or self.only_accepted:
                marker = [F.lit(1).alias(f"_{name}")] if how != "inner" else []
                dim = self.dim(name).select(on, *extra, *marker)
                lines = attach(lines, dim, on, how)
        if at_list:
            lines = lines.withColumn("unit_price", F.col("list_price"))
        return lines

    def sales(self, *columns: str, during: Period | None = None) -> DataFrame:
        derived = [c for c in columns if c in INPUTS]
        needed = set(columns) - set(derived) - set(CALENDAR)
        needed = needed.union(*[INPUTS[c] for c in derived])
        if during or any(c in CALENDAR for c in columns):
            needed.add("date")
        lines = self._raw_lines(needed, "inner")
        if during:
            lines = lines.where(during.covers(F.col("date")))
        return lines.select(*[_column(c, LINE_MEASURES).alias(c) for c in columns])

    @property
    def line_id(self) -> list[str]:
        return ["date", *[c for c in self.extracts.line_order if c != "date"]]

    def _references(self, also: list[str]) -> tuple[DataFrame, dict[str, str]]:
        lines = self.extracts.lines({*KEYS.values(), "date", *also})
        on = {n: k if k in lines.columns else DIMENSIONS[n][0] for n, k in KEYS.items()}
        kept = dict.fromkeys([*on.values(), *[c for c in also if c != "date_key"]])
        return lines.select(*kept, CALENDAR["date_key"](F.col("date")).alias("date_key")), on

    def line_references(self, calendar: bool) -> tuple[DataFrame, dict[str, str]]:
        lines, on = self._references([])
        return (lines, on | {"date": "date_key"}) if calendar else (lines.drop("date_key"), on)

    def identified_references(self) -> tuple[DataFrame, list[str]]:
        lines, on = self._references(self.line_id)
        return lines, [*on.values(), "date_key"]

    def fact_sales(self, during: Period | None = None, after: int = 0) -> DataFrame:
        """The fact with dense keys in date order, ties by the lines' own identity."""
        identity = self.line_id[1:]
        extra = [c for c in identity if c not in FACT_SALES.names]
        lines = self.sales("date", *FACT_SALES.names[1:], *extra, during=during)
        numbered = number_lines(lines, identity, "sale_key", after)
        return numbered.select(*FACT_SALES.names)

    def accepted(self) -> ExtractStar:
        """The same star over only those lines whose look-ups all succeed."""
        same = copy(self)  # keeps dimensions that are already numbered
        same.only_accepted = True
        return same

    def rejects(self) -> DataFrame:
        """Sale lines whose product, store or customer is unknown, with the reasons."""
        needed = set(KEYS.values()) | set(self.extracts.line_order) | {"date"}
        lines = self._raw_lines(needed, "left")
        missing = F.concat_ws(
            ",", *[F.when(F.col(f"_{n}").isNull(), n) for n in DIMENSIONS]
        )
        keep = [c for c in lines.columns if not c.startswith("_")]
        return lines.withColumn("missing", missing).where(F.col("missing") != "").select(
            *keep, "missing"
        )


class WarehouseStar(Star):
    """A star read back from written tables."""

    def __init__(
        self, spark: SparkSession, tables: dict[str, DataFrame], settings: Settings = DEFAULTS
    ):
        super().__init__(spark, settings)
        self.tables = tables

    def _build_dim(self, name: str) -> DataFrame:
        return self.tables[f"dim_{name}"]

    @property
    def dim_date(self) -> DataFrame:
        return self.tables["dim_date"]

    def span(self) -> DataFrame:
        kept = "day_totals" if "day_totals" in self.tables else "fact_sales"
        keys = self.tables[kept].agg(
            F.min("date_key").alias("first"), F.max("date_key").alias("last")
        )
        return keys.select(
            date_of_key(F.col("first")).alias("first_date"),
            date_of_key(F.col("last")).alias("last_date"),
        )

    def calendar_end(self) -> DataFrame:
        return self.dim_date.agg(F.max("date").alias("last_date"))

    @property
    def line_id(self) -> list[str]:
        return ["sale_key"]

    def fact_sales(self) -> DataFrame:
        return self.tables["fact_sales"].select(*FACT_SALES.names)

    def day_totals(self, columns: list[str], bases: list[str], during: Period | None = None) -> DataFrame | None:
        """The maintained totals answer for any calendar column, the store's key and its attributes."""
        attributes = [c for c in STORE if c in columns]
        if "day_totals" not in self.tables or not set(columns) <= {*CALENDAR, "store_key", *STORE}:
            return None
        kept = self.tables["day_totals"]
        if during:
            first, last = during.keys()
            kept = kept.where(F.col("year_month").between(first // 100, last // 100))
            kept = kept.where(F.col("date_key").between(first, last))
        kept = kept.withColumn("date", date_of_key(F.col("date_key")))
        if attributes:
            kept = attach(kept, self.dim_store.select("store_key", *attributes), "store_key")
        wanted = [c for c in dict.fromkeys(["date", *columns]) if c not in bases]
        return kept.select(*[_column(c, {}).alias(c) for c in wanted], *bases)

    def month_customers(self) -> DataFrame:
        if "month_customers" not in self.tables:
            return super().month_customers()
        month = F.col("year_month")
        index = F.floor(month / 100).cast("int") * 12 + month % 100
        return self.tables["month_customers"].select(index.alias("month_idx"), bitmaps.WORD, bitmaps.BITS)

    def sales(self, *columns: str, during: Period | None = None) -> DataFrame:
        needed = set(columns) - set(CALENDAR)
        if any(c in CALENDAR for c in columns):
            needed.add("date_key")
        attributes = {
            name: [c for c in DIMENSIONS[name] if c in needed] for name in DIMENSIONS
        }
        needed |= {KEYS[n] for n, cols in attributes.items() if cols}
        fact = self.tables["fact_sales"]
        if during:  # whole months are pruned as partitions, the days by file statistics
            first, last = during.keys()
            fact = fact.where(F.col("year_month").between(first // 100, last // 100))
            fact = fact.where(F.col("date_key").between(first, last))
        lines = fact.select(*[c for c in FACT_SALES.names if c in needed])
        for name, cols in attributes.items():
            if cols:
                lines = attach(lines, self.dim(name).select(KEYS[name], *cols), KEYS[name])
        if "date_key" in needed:
            lines = lines.withColumn("date", date_of_key(F.col("date_key")))
        return lines.select(*[_column(c, {}).alias(c) for c in columns])


#: Values that a column may have: a list, or a frame with a column of that name and of any size.
Allowed = list | DataFrame
#: Parts of the lines of one value, where values are too many to broadcast.
PARTS = 8


def _among(lines: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Semi join with values that are few or many, however many lines hold one value.

    Few are broadcast and the lines stay where they are.  Many meet lines that are dealt over some parts
    of every value, so that a sum per value does not go on in the join's own tasks, one for each value;
    adaptive execution may then split a part that holds very many lines.
    """
    if fits_broadcast(values):
        return lines.join(F.broadcast(values), column, "left_semi").select(lines.columns)
    dealt = lines.withColumn("_part", F.pmod(F.xxhash64(*lines.columns), F.lit(PARTS)).cast("int"))
    spread = values.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return dealt.join(spread, [column, "_part"], "left_semi").select(lines.columns)


def _kept(lines: DataFrame, allowed: dict[str, Allowed]) -> DataFrame:
    for column, values in allowed.items():
        if isinstance(values, DataFrame):
            lines = _among(lines, values.select(column).distinct(), column)
        else:
            lines = lines.where(F.col(column).isin(values))
    return lines


class ScenarioStar(Star):
    """A star whose sale lines went through ``change``; ``reads`` are the columns it needs."""

    def __init__(self, base: Star, reads: list[str], change: Callable[[DataFrame], DataFrame]):
        super().__init__(base.spark, base.settings)
        self.base = base
        self.reads = reads
        self.change = change

    def _build_dim(self, name: str) -> DataFrame:
        return self.base.dim(name)

    @property
    def line_id(self) -> list[str]:
        return self.base.line_id

    def sales(self, *columns: str, during: Period | None = None) -> DataFrame:
        # A change keeps a line's date, so that the period prunes what the base reads.
        read = list(dict.fromkeys([*columns, *self.reads]))
        return self.change(self.base.sales(*read, during=during)).select(*columns)

    @property
    def extracts(self) -> Extracts:
        """The masters and raw lines stay those of the base."""
        return self.base.extracts

    def fact_sales(self) -> DataFrame:
        """The changed lines, numbered anew in date order."""
        extra = [c for c in self.line_id if c not in FACT_SALES.names[1:] and c != "date"]
        lines = self.sales("date", *FACT_SALES.names[1:], *extra)
        return number_lines(
            lines.withColumnRenamed("sale_key", "_line"),
            ["_line" if c == "sale_key" else c for c in self.line_id],
            "sale_key",
        ).select(*FACT_SALES.names)


class ViewStar(ScenarioStar):
    """A star restricted to some values of attributes, as slicers and security roles do.

    Every query takes it.  Lines and the dimensions that own the attributes are restricted; the
    calendar stays that of the whole star, so a period without visible sales is blank.  Allowed
    values that are a frame meet lines and dimensions in a semi join and never come to the driver.
    A line has the same key under every role.
    """

    def __init__(self, base: Star, allowed: dict[str, Allowed]):
        super().__init__(base, list(allowed), lambda lines: _kept(lines, allowed))
        self.allowed = allowed

    def _build_dim(self, name: str) -> DataFrame:
        own = {c: v for c, v in self.allowed.items() if c in [KEYS[name], *DIMENSIONS[name]]}
        return _kept(self.base.dim(name), own)

    def span(self) -> DataFrame:
        return self.base.span()

    @property
    def dim_date(self) -> DataFrame:
        own = {c: v for c, v in self.allowed.items() if c in self.base.dim_date.columns}
        return _kept(self.base.dim_date, own)

    def fact_sales(self) -> DataFrame:
        """The visible lines of the base's fact, with the keys that they have there.

        A dimension that owns an allowed attribute is restricted already, so its keys decide.
        """
        fact = self.base.fact_sales()
        lines = fact
        for name, key in KEYS.items():
            if any(c in [key, *DIMENSIONS[name]] for c in self.allowed):
                lines = lines.join(self.dim(name).select(key), key, "left_semi")
        days = [c for c in self.allowed if c in CALENDAR]
        day = date_of_key(F.col("date_key"))
        dated = lines.select("*", *[CALENDAR[c](day).alias(c) for c in days if c not in lines.columns])
        own = [c for c in self.allowed if c in dated.columns and c not in KEYS.values()]
        return _kept(dated, {c: self.allowed[c] for c in own}).select(*fact.columns)
