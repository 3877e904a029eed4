"""Declared schemas of the extracts, the star and the marts; nothing is inferred at read."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "long": T.LongType(),
        "int": T.IntegerType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "date": T.DateType(),
    }
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


PRODUCTS = _struct(
    "product_id string, product_name string, category string, subcategory string, "
    "brand string, list_price double, unit_cost double"
)
STORES = _struct(
    "store_id string, store_name string, city string, region string, "
    "store_type string, open_date date"
)
CUSTOMERS = _struct(
    "customer_id string, gender string, age_band string, city string, "
    "loyalty_tier string, signup_date date"
)
TRANSACTIONS = _struct(
    "transaction_id long, date date, product_id string, store_id string, customer_id string, "
    "quantity int, discount_pct double, is_return int, unit_price double"
)

DIM_DATE = _struct(
    "date_key int, date date, year int, quarter int, month int, month_name string, "
    "month_name_it string, week int, day_of_week int, day_name string, is_weekend int, "
    "is_holiday int, season string"
)
DIM_PRODUCT = T.StructType([T.StructField("product_key", T.LongType()), *PRODUCTS.fields])
DIM_STORE = T.StructType([T.StructField("store_key", T.LongType()), *STORES.fields])
DIM_CUSTOMER = T.StructType([T.StructField("customer_key", T.LongType()), *CUSTOMERS.fields])
FACT_SALES = _struct(
    "sale_key long, date_key int, product_key long, store_key long, customer_key long, "
    "quantity int, unit_price double, discount_pct double, gross_sales double, "
    "discount_amount double, net_sales double, cost_amount double, gross_margin double, "
    "is_return int"
)
# kept beside the star: sums per day and store in whole cents, and each month's customers as bits
DAY_TOTALS = _struct(
    "date_key int, store_key long, net long, gross long, cost long, margin long, discount long, "
    "units long, lines long, returns long"
)
MONTH_CUSTOMERS = _struct("word long, bits long")
FORECAST_DAILY = _struct(
    "date date, actual double, forecast double, lower_bound double, upper_bound double, "
    "segment string"
)
ANOMALIES = _struct(
    "date date, store_id string, store_name string, region string, net_sales double, "
    "expected double, robust_z double, is_anomaly int, direction string"
)

STAR_TABLES = {
    "dim_date": DIM_DATE,
    "dim_product": DIM_PRODUCT,
    "dim_store": DIM_STORE,
    "dim_customer": DIM_CUSTOMER,
    "fact_sales": FACT_SALES,
}
MONTHLY_TABLES = {"fact_sales": FACT_SALES, "day_totals": DAY_TOTALS, "month_customers": MONTH_CUSTOMERS}
MART_TABLES = {"forecast_daily": FORECAST_DAILY, "anomalies": ANOMALIES}
