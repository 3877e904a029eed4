"""Measures at a grain, slicers, and time intelligence."""

from __future__ import annotations

import datetime
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.calendar import Period, month_index, year_month
from salesmart.functions.bitmaps import BITS, WORD, bit_of, members, word_of
from salesmart.functions.bitmaps import merged as merged_bits
from salesmart.functions.measures import (
    CUSTOMERS,
    MEASURES,
    bases_of,
    columns_of,
    final,
    margin_status,
    measure,
    merged,
    partial,
    trend_label,
)
from salesmart.functions.rounding import money_over, ratio
from salesmart.operators.series import daily_sales
from salesmart.plans.analytics import monthly_sales


def kpi(
    star,
    by: list[str],
    measures: list[str] | None = None,
    slicers: dict[str, object] | None = None,
    during: Period | None = None,
) -> DataFrame:
    """Evaluate measures per group of ``by`` under equality or ``IN`` slicers and in a period.

    ``by`` and the slicers take any key, attribute or calendar column of the star.  Only the
    columns the measures read are scanned, and only the dimensions named are joined.

    Lines are read once.  With distinct customers, they are summed per group and word of 64
    customers, whose bits tell who bought; these rows are then added up and their bits counted.
    Sums alone come from the star's day totals where these know all columns asked for.
    """
    names = measures or list(MEASURES)
    bases = bases_of(names)
    return _final(_by_word(star, by, bases, slicers, during), by, bases).select(*by, *[measure(n) for n in names])


def kpi_rollup(star, by: list[str], measures: list[str] | None = None, slicers=None, during=None) -> DataFrame:
    """Measures at every level of ``by``: the groups, their subtotals from the right, and the total.

    ``level`` is the number of columns that a row has a value of.  A customer of several groups
    counts once in their subtotal: sets are merged, not counts.
    """
    names = measures or list(MEASURES)
    bases = bases_of(names)
    words = [F.col(WORD)] if CUSTOMERS in bases else []
    rows = _by_word(star, by, bases, slicers, during)
    columns = [*[F.col(c) for c in by], *words]
    levels = [[*columns[:n], *words] for n in range(len(by), -1, -1)]
    kinds = F.grouping_id(*columns).alias("_id")
    sets = [merged_bits(F.col(BITS)).alias(BITS)] if words else []
    summed = rows.groupingSets(levels, *columns).agg(kinds, *[merged(b) for b in bases if b != CUSTOMERS], *sets)
    # the id has a bit for each column that is summed over, the last column's the lowest
    shift = len(words)
    level = F.lit(len(by)) - F.bit_count(F.shiftright("_id", shift))
    total = _final(summed.withColumn("level", level.cast("int")).drop("_id"), ["level", *by], bases)
    return total.select("level", *by, *[measure(n) for n in names])


def _by_word(star, by: list[str], bases: list[str], slicers, during) -> DataFrame:
    """Partial sums per group, and per word of customers if these are counted."""
    sums = [b for b in bases if b != CUSTOMERS]
    if CUSTOMERS not in bases:
        totals = star.day_totals([*by, *(slicers or {})], sums, during)
        if totals is not None:
            return _kept(totals, slicers).groupBy(*by).agg(*[merged(b) for b in sums])
        lines = _sliced(star, list(dict.fromkeys([*by, *columns_of(sums)])), slicers, during)
        return lines.groupBy(*by).agg(*[partial(b) for b in sums])
    columns = list(dict.fromkeys([*by, *columns_of(sums), "customer_key"]))
    customer = F.col("customer_key")
    lines = _sliced(star, columns, slicers, during)
    return lines.groupBy(*by, word_of(customer).alias(WORD)).agg(
        *[partial(b) for b in sums], merged_bits(bit_of(customer)).alias(BITS)
    )


def _final(rows: DataFrame, by: list[str], bases: list[str]) -> DataFrame:
    """Words added up to groups; money as an amount."""
    aggregates = [members(F.col(BITS)).alias(b) if b == CUSTOMERS else merged(b) for b in bases]
    groups = rows.groupBy(*by).agg(*aggregates)
    return groups.select(*by, *[F.col(b) if b == CUSTOMERS else final(b) for b in bases])


def _kept(rows: DataFrame, slicers: dict[str, object] | None) -> DataFrame:
    for column, allowed in (slicers or {}).items():
        values = allowed if isinstance(allowed, (list, tuple, set)) else [allowed]
        rows = rows.where(F.col(column).isin(list(values)))
    return rows


def _sliced(
    star, columns: list[str], slicers: dict[str, object] | None, during: Period | None
) -> DataFrame:
    extra = [c for c in slicers or {} if c not in columns]
    return _kept(star.sales(*columns, *extra, during=during), slicers).select(*columns)


def kpi_base(star) -> DataFrame:
    return kpi(star, ["category", "month_idx"])


def kpi_sliced(star, year: int, slicers: dict[str, object]) -> DataFrame:
    """Months of one year under slicers; the year is a range of days, so the scan is pruned."""
    return kpi(
        star,
        ["month"],
        ["total_net_sales", "gross_margin", "gross_margin_pct", "total_quantity", "return_lines"],
        slicers,
        Period(datetime.date(year, 1, 1), datetime.date(year, 12, 31)),
    )


def calendar_days(star) -> DataFrame:
    """Every day of the calendar with its net sales, blank (null) on days without sales."""
    return star.dim_date.select("date").join(daily_sales(star), "date", "left")


def calendar_months(star) -> DataFrame:
    """Every month of the calendar with its net sales, blank (null) in months without sales."""
    day = F.col("date")
    months = star.dim_date.select(month_index(day).alias("month_idx"), year_month(day).alias("ym"))
    return months.distinct().join(monthly_sales(star).drop("ym"), "month_idx", "left")


def _difference(current: Column, before: Column) -> Column:
    """Change in which one blank side counts as nothing; blank if both sides are."""
    change = F.coalesce(current, F.lit(0.0)) - F.coalesce(before, F.lit(0.0))
    return F.when(current.isNotNull() | before.isNotNull(), change)


def sales_to_date(star) -> DataFrame:
    """Running totals since the start of the year, quarter and month, per day of the calendar.

    A total is blank until the first sale of its period and is carried over days without sales.
    """
    year, quarter, month = F.year("date"), F.quarter("date"), F.month("date")

    def running(*period: Column) -> Column:
        days = Window.partitionBy(*period).orderBy("date")
        return money_over(
            F.col("net_sales"), days.rowsBetween(Window.unboundedPreceding, 0)
        )

    return calendar_days(star).select(
        "date",
        "net_sales",
        running(year).alias("sales_ytd"),
        running(year, quarter).alias("sales_qtd"),
        running(year, month).alias("sales_mtd"),
    )


def _months_back(first: int, last: int) -> Column:
    """Net sales of the months ``first`` to ``last`` before the current one, by calendar."""
    months = Window.orderBy("month_idx").rangeBetween(-first, -last)
    return money_over(F.col("net_sales"), months)


def monthly_time_intelligence(star) -> DataFrame:
    """Per month of the calendar: prior year, prior month, rolling 3 and 12 months and growth.

    The calendar runs on after the last sale.  A month without sales is blank itself, and has the
    comparisons and rolling sums that its date gives it.
    """
    current, year_ago, month_ago = F.col("net_sales"), F.col("sales_py"), F.col("sales_pm")
    change = _difference(current, year_ago)
    return (
        calendar_months(star)
        .withColumn("sales_py", _months_back(12, 12))
        .withColumn("sales_pm", _months_back(1, 1))
        .withColumn("rolling_3m", _months_back(2, 0))
        .withColumn("rolling_12m", _months_back(11, 0))
        .withColumn("sales_yoy", change)
        .withColumn("sales_yoy_pct", ratio(change, year_ago))
        .withColumn("sales_mom_pct", ratio(_difference(current, month_ago), month_ago))
    )


def kpi_yoy(star) -> DataFrame:
    return monthly_time_intelligence(star).select(
        "ym", "net_sales", "sales_py", "sales_yoy", "sales_yoy_pct"
    )


def kpi_mom(star) -> DataFrame:
    return monthly_time_intelligence(star).select("ym", "net_sales", "sales_pm", "sales_mom_pct")


def rolling_months(star) -> DataFrame:
    return monthly_time_intelligence(star).select("ym", "net_sales", "rolling_3m", "rolling_12m")


def kpi_yoy_daily(star) -> DataFrame:
    """Each calendar day against the day a year before; 29 February meets 28 February."""
    year_ago = daily_sales(star).select(
        F.col("date").alias("day_py"), F.col("net_sales").alias("sales_py")
    )
    change = _difference(F.col("net_sales"), F.col("sales_py"))
    return (
        calendar_days(star).withColumn("day_py", F.add_months("date", -12))
        .join(year_ago, "day_py", "left")
        .select(
            "date",
            "net_sales",
            "sales_py",
            change.alias("sales_yoy"),
            ratio(change, F.col("sales_py")).alias("sales_yoy_pct"),
        )
    )


def new_returning(star) -> DataFrame:
    """Customers per month: all, first-time and returning.

    A month's customers are a set of bits.  Those of all months before, an OR over a window of
    each word of 64 customers, leave the first-time ones; the lines are read once, or not at all
    where the star keeps the sets.
    """
    earlier = Window.partitionBy(WORD).orderBy("month_idx").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.bit_or(BITS).over(earlier), F.lit(0).cast("bigint"))
    fresh = F.col(BITS).bitwiseAND(F.bitwise_not(seen))
    month = F.col("month_idx") - 1
    label = F.format_string("%d-%02d", F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"))
    return (
        star.month_customers().where(F.col(WORD).isNotNull())
        .withColumn("new", fresh)
        .groupBy("month_idx")
        .agg(members(F.col(BITS)).alias("customer_count"), members(F.col("new")).alias("new_customers"))
        .select(
            label.alias("ym"), "customer_count", "new_customers",
            (F.col("customer_count") - F.col("new_customers")).alias("returning_customers"),
        )
    )


def kpi_labels(star) -> DataFrame:
    """Per month of the calendar: growth against the prior year as text, and the margin's light."""
    sums = kpi(star, ["month_idx"], ["total_net_sales", "gross_margin"])
    sums = sums.withColumnRenamed("total_net_sales", "net_sales")
    day = F.col("date")
    months = star.dim_date.select(month_index(day).alias("month_idx"), year_month(day).alias("ym"))
    year_ago = F.col("sales_py")
    growth = ratio(_difference(F.col("net_sales"), year_ago), year_ago)
    return (
        months.distinct()
        .join(sums, "month_idx", "left")
        .withColumn("sales_py", _months_back(12, 12))
        .select(
            "ym",
            trend_label(growth).alias("yoy_arrow"),
            margin_status(ratio(F.col("gross_margin"), F.col("net_sales"))).alias("margin_status"),
        )
    )
