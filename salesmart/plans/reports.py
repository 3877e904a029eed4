"""The datasets behind the report pages; each is one query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.calendar import year_month
from salesmart.functions.rounding import money_over, money_sum, ratio, side_by_side
from salesmart.operators.lookup import attach
from salesmart.operators.series import daily_sales
from salesmart.plans.kpis import kpi, monthly_time_intelligence, new_returning

CARD_MEASURES = ["total_net_sales", "gross_margin_pct", "avg_order_value", "return_rate_pct"]


def exec_cards(star) -> DataFrame:
    """One row: totals over everything, growth and rolling sales as of the last month with sales."""
    latest = (
        monthly_time_intelligence(star)
        .where(F.col("net_sales").isNotNull())
        .orderBy(F.desc("month_idx"))
        .limit(1)
        .select(F.col("ym").alias("last_month"), "sales_yoy_pct", "sales_mom_pct", "rolling_3m")
    )
    totals = kpi(star, [], CARD_MEASURES)
    return side_by_side([totals, latest])


def exec_trend(star) -> DataFrame:
    return monthly_time_intelligence(star).select("ym", "net_sales", "sales_py")


def product_facts(star) -> DataFrame:
    """Net sales, margin and quantity per product: the lines are summed by key, then named."""
    totals = star.sales("product_key", "net_sales", "gross_margin", "quantity").groupBy(
        "product_key"
    ).agg(
        money_sum(F.col("net_sales")).alias("net_sales"),
        money_sum(F.col("gross_margin")).alias("gross_margin"),
        F.sum("quantity").alias("quantity"),
    )
    names = star.dim_product.select(
        "product_key", "product_id", "product_name", "category", "subcategory"
    )
    return attach(totals, names, "product_key")


def product_matrix(star) -> DataFrame:
    """Category, subcategory and product with subtotals; ``level`` counts the open columns.

    The rollup expands product totals, not sale lines.  A product is told apart by its
    id, since different products may share a name.
    """
    rolled = (
        product_facts(star)
        .rollup("category", "subcategory", "product_id")
        .agg(
            F.grouping_id().alias("grouping"),
            F.min("product_name").alias("any_name"),
            money_sum(F.col("net_sales")).alias("net_sales"),
            money_sum(F.col("gross_margin")).alias("gross_margin"),
            F.sum("quantity").alias("quantity"),
        )
    )
    level = F.when(F.col("grouping") == 0, 3).when(F.col("grouping") == 1, 2)
    level = level.when(F.col("grouping") == 3, 1).otherwise(0)
    return rolled.select(
        level.cast("int").alias("level"),
        "category",
        "subcategory",
        "product_id",
        F.when(F.col("grouping") == 0, F.col("any_name")).alias("product_name"),
        "net_sales",
        "gross_margin",
        ratio(F.col("gross_margin"), F.col("net_sales")).alias("gross_margin_pct"),
        "quantity",
    )


def product_scatter(star) -> DataFrame:
    return product_facts(star).select(
        "product_key",
        "product_name",
        "net_sales",
        ratio(F.col("gross_margin"), F.col("net_sales")).alias("gross_margin_pct"),
    )


def store_yoy(star) -> DataFrame:
    """Store and year: sales and growth against the same store's year before."""
    yearly = star.sales("store_key", "year", "net_sales").groupBy("store_key", "year").agg(
        money_sum(F.col("net_sales")).alias("net_sales")
    )
    year_before = Window.partitionBy("store_key").orderBy("year").rangeBetween(-1, -1)
    stores = star.dim_store.select("store_key", "store_name", "region", "store_type")
    year_ago = F.col("sales_py")
    return attach(
        yearly.withColumn("sales_py", money_over(F.col("net_sales"), year_before)),
        stores,
        "store_key",
    ).select(
        "store_name",
        "region",
        "store_type",
        "year",
        "net_sales",
        "sales_py",
        ratio(F.col("net_sales") - year_ago, year_ago).alias("sales_yoy_pct"),
    )


def customer_cards(star) -> DataFrame:
    """Per month: customers, new customers and sales per customer."""
    sales = kpi(star, ["year_month"], ["total_net_sales"]).withColumnRenamed("year_month", "ym")
    return (
        new_returning(star)
        .join(sales, "ym")
        .select(
            "ym",
            "customer_count",
            "new_customers",
            ratio(F.col("total_net_sales"), F.col("customer_count")).alias("sales_per_customer"),
        )
    )


def forecast_totals(forecast: DataFrame) -> DataFrame:
    """Forecast and band per month; past months hold the fitted values and have no band."""
    return forecast.groupBy(year_month(F.col("date")).alias("ym")).agg(
        money_sum(F.col("forecast")).alias("forecast_sales"),
        money_sum(F.col("lower_bound")).alias("forecast_lower"),
        money_sum(F.col("upper_bound")).alias("forecast_upper"),
    )


def actual_vs_forecast(star, forecast: DataFrame) -> DataFrame:
    """Every calendar day with its sales, its forecast and the band."""
    ahead = forecast.select("date", "forecast", "lower_bound", "upper_bound")
    return (
        star.dim_date.select("date")
        .join(daily_sales(star), "date", "left")
        .join(ahead, "date", "left")
    )


def loyalty_age_sales(star) -> DataFrame:
    """Net sales by loyalty tier and age band.

    Lines are summed per customer first: one row per customer meets the customer dimension.
    """
    totals = star.sales("customer_key", "net_sales").groupBy("customer_key").agg(
        money_sum(F.col("net_sales")).alias("net_sales")
    )
    people = star.dim_customer.select("customer_key", "loyalty_tier", "age_band")
    summed = attach(totals, people, "customer_key")
    return summed.groupBy("loyalty_tier", "age_band").agg(
        money_sum(F.col("net_sales")).alias("net_sales")
    )
