"""Adapter: order, line, part, supplier and customer tables as sales extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.rounding import round_cents
from salesmart.operators.lookup import attach
from salesmart.sources.extracts import Extracts

# Margin fraction per product category.
MARGINS = {
    "STANDARD": 0.55,
    "ECONOMY": 0.22,
    "MEDIUM": 0.45,
    "PROMO": 0.28,
    "SMALL": 0.50,
    "LARGE": 0.42,
}
# Columns that together identify a sale line in these tables.
LINE_ORDER = (
    "l_orderkey", "l_linenumber", "product_key", "store_key", "l_quantity", "l_extendedprice",
)


def _by_value(column: Column, values: dict[str, float]) -> Column:
    items = [F.lit(x) for pair in values.items() for x in pair]
    return F.element_at(F.create_map(*items), column)


LINE_COLUMNS = {
    "date": lambda: F.to_date("l_shipdate"),
    "product_key": lambda: F.col("l_partkey"),
    "store_key": lambda: F.col("l_suppkey"),
    "quantity": lambda: F.col("l_quantity").cast("int"),
    "discount_pct": lambda: F.col("l_discount") + F.lit(0.0),
    "is_return": lambda: (F.col("l_returnflag") == "R").cast("int"),
}
# Declared, so that opening a table starts no job to read its footer.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


class OrderTables:
    """The tables of one folder, mapped to products, stores, customers and sale lines.

    Nations and regions are fixed lists of 25 and 5 rows at any scale, so they are broadcast.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def products(self) -> DataFrame:
        price = F.col("p_retailprice")
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").alias("product_key"),
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.when(size <= 15, "S").when(size <= 35, "M").otherwise("L").alias("subcategory"),
            F.col("p_brand").alias("brand"),
            price.alias("list_price"),
            round_cents(price * (1 - _by_value(F.col("p_type"), MARGINS))).alias("unit_cost"),
        )

    def _places(self) -> DataFrame:
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("nation").join(F.broadcast(region), "n_regionkey")

    def user_region(self) -> DataFrame:
        """One manager per nation, who sees the nation's region."""
        email = F.concat(F.lower("n_name"), F.lit("@example.com"))
        return self._places().select(email.alias("email"), F.col("r_name").alias("region"))

    def stores(self) -> DataFrame:
        balance = F.col("s_acctbal")
        places = self._places().withColumnRenamed("n_nationkey", "s_nationkey")
        return self.table("supplier").join(F.broadcast(places), "s_nationkey").select(
            F.col("s_suppkey").alias("store_key"),
            F.col("s_suppkey").cast("string").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            F.when(balance >= 7000, "Flagship")
            .when(balance < 1000, "Outlet")
            .otherwise("Standard")
            .alias("store_type"),
            F.lit(None).cast("date").alias("open_date"),
        )

    def customers(self) -> DataFrame:
        balance = F.col("c_acctbal")
        nation = self.table("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return self.table("customer").join(F.broadcast(nation), "c_nationkey", "left").select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.lit("N/D").alias("gender"),
            F.col("c_mktsegment").alias("age_band"),
            F.col("n_name").alias("city"),
            F.when(balance < 2500, "Bronze")
            .when(balance < 5500, "Silver")
            .when(balance < 8500, "Gold")
            .otherwise("Platinum")
            .alias("loyalty_tier"),
            F.lit(None).cast("date").alias("signup_date"),
        )

    def lines(self, columns: set[str]) -> DataFrame:
        """The order header is joined only for the customer, the one column it adds."""
        wanted = [LINE_COLUMNS[c]().alias(c) for c in LINE_COLUMNS if c in columns]
        wanted += [F.col(c) for c in LINE_ORDER if c in columns and c not in LINE_COLUMNS]
        items = self.table("lineitem")
        if "customer_key" not in columns:
            return items.select(*wanted)
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("_order"), F.col("o_custkey").alias("customer_key")
        )
        items = items.select(F.col("l_orderkey").alias("_order"), *wanted)
        return attach(items, orders, "_order", "left").drop("_order")


def order_table_extracts(spark: SparkSession, folder: str) -> Extracts:
    tables = OrderTables(spark, folder)
    return Extracts(
        tables.products,
        tables.stores,
        tables.customers,
        tables.lines,
        LINE_ORDER,
        has_price=False,
        user_region=tables.user_region,
    )
