"""One Spark session, and a builder of small stars from plain rows."""

from __future__ import annotations

import datetime
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from salesmart import schema  # noqa: E402
from salesmart.plans.star import ExtractStar  # noqa: E402
from salesmart.settings import DEFAULTS  # noqa: E402
from salesmart.sources.extracts import Extracts  # noqa: E402
from salesmart.sources.order_tables import order_table_extracts  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny(spark):
    """The star over the smallest test tables."""
    return ExtractStar(spark, order_table_extracts(spark, f"{TESTDATA}/sf0.001"))


def day(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


PRODUCTS = [
    ("P1", "Lamp", "Home", "Light", "Vela", 10.0, 4.0),
    ("P2", "Sofa", "Home", "Seat", "Nord", 100.0, 70.0),
    ("P3", "Ball", "Sport", "Outdoor", "Vela", 5.0, 5.0),
]
STORES = [
    ("S1", "North", "Milano", "Lombardia", "Flagship", day("2015-01-01")),
    ("S2", "South", "Napoli", "Campania", "Standard", day("2016-01-01")),
]
CUSTOMERS = [
    (f"C{i}", "F", "25-34", "Milano", "Gold", day("2020-01-01")) for i in range(1, 8)
]


def sale(number, date, product="P1", store="S1", customer="C1", quantity=1, discount=0.0,
         is_return=0, price=10.0):
    return (
        number, day(date), product, store, customer, quantity, float(discount), is_return,
        float(price),
    )


@pytest.fixture(scope="session")
def build(spark):
    """Make a star from sale rows and optional masters."""

    def make(sales, products=PRODUCTS, stores=STORES, customers=CUSTOMERS, settings=DEFAULTS):
        lines = spark.createDataFrame(sales, schema.TRANSACTIONS)
        return ExtractStar(
            spark,
            Extracts(
                lambda: spark.createDataFrame(products, schema.PRODUCTS),
                lambda: spark.createDataFrame(stores, schema.STORES),
                lambda: spark.createDataFrame(customers, schema.CUSTOMERS),
                lambda columns: lines,
                ("transaction_id",),
            ),
            settings,
        )

    return make
