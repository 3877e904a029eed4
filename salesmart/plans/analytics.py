"""The analytical queries: growth, top products, store rank, shares, smoothing, RFM."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.calendar import month_index, year_month
from salesmart.functions.rounding import cents, money_over, money_sum, ratio, round_half_up
from salesmart.operators.lookup import attach
from salesmart.operators.ranking import add_rank, written
from salesmart.operators.selection import add_tiles
from salesmart.operators.series import daily_sales


def monthly_sales(star) -> DataFrame:
    """Net sales per month.  Days are summed first, so month labels cost a few rows only."""
    day = F.col("date")
    return (
        daily_sales(star)
        .select(
            month_index(day).alias("month_idx"), year_month(day).alias("ym"), "net_sales"
        )
        .groupBy("month_idx", "ym")
        .agg(money_sum(F.col("net_sales")).alias("net_sales"))
    )


def monthly_yoy(star) -> DataFrame:
    """Month, the 12th row before it, and the growth between them; positions, not calendar."""
    before = F.lag("net_sales", 12).over(Window.orderBy("month_idx"))
    growth = ratio(100.0 * (F.col("net_sales") - F.col("net_sales_py")), F.col("net_sales_py"))
    return (
        monthly_sales(star)
        .withColumn("net_sales_py", before)
        .withColumn("yoy_pct", round_half_up(growth, 1))
        .orderBy("month_idx")
        .select("ym", "net_sales", "net_sales_py", "yoy_pct")
    )


def product_totals(star) -> DataFrame:
    return star.sales("product_key", "net_sales", "gross_margin").groupBy("product_key").agg(
        money_sum(F.col("net_sales")).alias("net_sales"),
        money_sum(F.col("gross_margin")).alias("gross_margin"),
    )


def top_products_margin(star) -> DataFrame:
    """Products with the highest rounded margin; names are looked up for the winners only."""
    margin_pct = ratio(100.0 * F.col("gross_margin"), F.col("net_sales"))
    order = [F.desc("gross_margin"), F.asc("product_key")]
    winners = (
        product_totals(star)
        .select(
            "product_key",
            round_half_up(F.col("net_sales"), 0).alias("net_sales"),
            round_half_up(F.col("gross_margin"), 0).alias("gross_margin"),
            round_half_up(margin_pct, 1).alias("margin_pct"),
        )
        .orderBy(*order)
        .limit(star.settings.top_products)
    )
    names = star.dim_product.select("product_key", "product_name", "category")
    return (
        names.join(F.broadcast(winners), "product_key")
        .orderBy(*order)
        .select("product_name", "category", "net_sales", "gross_margin", "margin_pct")
    )


def store_rank(star) -> DataFrame:
    """Stores ranked by their unrounded net sales, with gaps after ties."""
    totals = star.sales("store_key", "net_sales").groupBy("store_key").agg(
        money_sum(F.col("net_sales")).alias("total")
    )
    ranked = add_rank(totals, "total", "store_key", "sales_rank")
    stores = star.dim_store.select("store_key", "store_name", "region", "store_type")
    return (
        attach(ranked, stores, "store_key")
        .withColumn("net_sales", round_half_up(F.col("total"), 0))
        .orderBy("sales_rank", "store_key")
        .select("store_name", "region", "store_type", "net_sales", "sales_rank")
    )


def share_by(star, attribute: str) -> DataFrame:
    """Net sales of each value of an attribute and its share of the total, a sum of its own."""
    totals = star.sales(attribute, "net_sales").groupBy(attribute).agg(
        money_sum(F.col("net_sales")).alias("net")
    )
    whole = totals.agg(money_sum(F.col("net")).alias("whole")).scalar()
    return (
        totals.select(
            attribute,
            round_half_up(F.col("net"), 0).alias("net_sales"),
            round_half_up(ratio(100.0 * F.col("net"), whole), 1).alias("pct_of_total"),
        )
        .orderBy(F.desc("net_sales"), F.asc(attribute))
    )


def category_share(star) -> DataFrame:
    return share_by(star, "category")


def sales_ma7(star) -> DataFrame:
    """Average of a day and the six days with sales before it."""
    week = Window.orderBy("date").rowsBetween(-6, 0)
    mean = money_over(F.col("net_sales"), week) / F.count(F.lit(1)).over(week)
    return (
        daily_sales(star)
        .withColumn("ma_7d", round_half_up(mean, 0))
        .orderBy("date")
    )


def rfm_scores(star) -> DataFrame:
    """Recency, frequency and monetary scores of every customer with a non-return line.

    Recency counts from the end of the calendar, which lies a forecast horizon after the
    last sale, or from ``as_of``, after which no line counts.  All ties are broken by the customer
    key.  The customers are written once and not
    sorted: the borders of all three scores come from the same scans.
    """
    bought = star.sales("customer_key", "date", "net_sales", "is_return").where(
        F.col("is_return") == 0
    )
    fixed = star.settings.as_of
    as_of = star.calendar_end().scalar() if fixed is None else F.lit(fixed)
    if fixed is not None:
        bought = bought.where(F.col("date") <= as_of)
    customers = (
        bought.groupBy("customer_key")
        .agg(
            F.max("date").alias("last_date"),
            F.count("*").cast("bigint").alias("frequency"),
            money_sum(F.col("net_sales")).alias("monetary"),
        )
        .select(
            "customer_key",
            F.datediff(as_of, "last_date")
            .cast("bigint")
            .alias("recency_days"),
            "frequency",
            "monetary",
        )
    )
    orders = {
        "r_score": -F.col("recency_days"),
        "f_score": F.col("frequency"),
        "m_score": cents(F.col("monetary")),
    }
    return add_tiles(written(customers), orders, "customer_key", star.settings.rfm_tiles)


def rfm_segments(star) -> DataFrame:
    return (
        rfm_scores(star)
        .withColumn("monetary", round_half_up(F.col("monetary"), 0))
        .orderBy(F.desc("monetary"), F.asc("customer_key"))
        .limit(star.settings.top_customers)
    )


def rfm_matrix(star) -> DataFrame:
    """Customers per R, F and M score."""
    return rfm_scores(star).groupBy("r_score", "f_score", "m_score").agg(
        F.count("*").cast("bigint").alias("customer_count"),
        money_sum(F.col("monetary")).alias("monetary"),
    )
