"""Source extracts: three masters and the sale lines, read with declared schemas."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart import schema
from salesmart.functions.typing import as_text, column_types, misfits, typed

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Extracts:
    """The masters are built when first asked for.

    ``lines(columns)`` returns the sale lines with at least the requested raw columns.

    A source passes natural ids (``product_id``) or ready keys (``product_key``); look-ups
    use whichever the sale lines carry.
    """

    products: Callable[[], DataFrame]
    stores: Callable[[], DataFrame]
    customers: Callable[[], DataFrame]
    lines: Callable[[set[str]], DataFrame]
    line_order: tuple[str, ...]  # unique within the lines; numbering breaks ties by it
    has_price: bool = True  # without a price of their own, lines sell at the list price
    corrupt: DataFrame | None = None
    user_region: Callable[[], DataFrame] | None = None  # email, region: who may see what


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The column names that a CSV file brings."""
    return spark.read.option("header", True).csv(path).columns


def read_csv(
    spark: SparkSession, path: str, struct: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of a CSV file, and the records that are malformed or hold a wrong value.

    Columns are found by the names in the header, in whatever order the file has them; a missing
    one is an error.  The test names every column, so that the parser checks whole records even when a query
    needs few columns.
    """
    types = column_types(struct)
    header = csv_header(spark, path)
    if missing := [c for c in types if c not in header]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    own = {f.name: f for f in as_text(struct).fields}
    found = [own.get(c, T.StructField(c, T.StringType())) for c in header]
    text = T.StructType([*found, T.StructField(CORRUPT, T.StringType())])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    unreadable = F.col(CORRUPT).isNotNull() | misfits(types)
    record = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *types))
    return raw.where(~unreadable).select(*typed(types)), raw.where(unreadable).select(
        record.alias("record")
    )


def read_extracts(spark: SparkSession, folder: str, fmt: str = "csv") -> Extracts:
    """Read ``products``, ``stores``, ``customers`` and ``transactions`` from a folder."""
    files = {
        "products": schema.PRODUCTS,
        "stores": schema.STORES,
        "customers": schema.CUSTOMERS,
        "transactions": schema.TRANSACTIONS,
    }
    corrupt = None
    frames = {}
    for name, struct in files.items():
        if fmt == "csv":
            frames[name], bad = read_csv(spark, f"{folder}/{name}.csv", struct)
            bad = bad.select(F.lit(name).alias("extract"), "record")
            corrupt = bad if corrupt is None else corrupt.unionByName(bad)
        else:
            frames[name] = spark.read.schema(struct).format(fmt).load(f"{folder}/{name}")
    return Extracts(
        lambda: frames["products"],
        lambda: frames["stores"],
        lambda: frames["customers"],
        lambda columns: frames["transactions"],
        ("transaction_id",),
        corrupt=corrupt,
    )


def profile(
    frame: DataFrame, required: list[str], minimum_rows: int, header: list[str] | None = None
) -> DataFrame:
    """One row per required column: present, and enough rows in the extract.

    ``header`` holds the names that the source itself brings, where the frame names more.
    """
    there = frame.columns if header is None else header
    rows = frame.agg(F.count("*").cast("bigint").alias("row_count"))
    checks = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(int(c in there)).alias("is_present"),
                )
                for c in required
            ]
        )
    )
    return rows.select(checks.alias("c"), "row_count").select(
        "c.column_name",
        "c.is_present",
        "row_count",
        (F.col("row_count") > minimum_rows).cast("int").alias("has_enough_rows"),
    )
