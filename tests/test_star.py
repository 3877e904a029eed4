"""Calendar, sale-line arithmetic, look-ups and integrity on hand-made rows."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import PRODUCTS, day, sale
from pyspark.sql import functions as F

from salesmart.functions.calendar import build_dim_date, date_key, date_of_key
from salesmart.functions.rounding import round_cents, round_half_up
from salesmart.operators import quality
from salesmart.sources import warehouse


def calendar(spark, first, last, horizon=0):
    span = spark.createDataFrame([(day(first), day(last))], "first_date date, last_date date")
    return {r["date"].isoformat(): r for r in build_dim_date(span, horizon).collect()}


def test_iso_week_keeps_calendar_year(spark):
    days = calendar(spark, "2024-12-29", "2025-01-01")
    assert [(d.year, d.week) for d in days.values()] == [(2024, 52), (2024, 1), (2024, 1), (2025, 1)]
    assert days["2024-12-30"].day_name == "Monday" and days["2024-12-30"].day_of_week == 1
    assert days["2024-12-29"].is_weekend == 1 and days["2024-12-29"].day_of_week == 7


def test_calendar_labels(spark):
    days = calendar(spark, "2023-12-24", "2024-04-25")
    assert days["2023-12-25"].is_holiday == 1 and days["2023-12-24"].is_holiday == 0
    assert days["2024-04-01"].is_holiday == 0  # Easter Monday is not a fixed date
    assert days["2024-04-25"].is_holiday == 1
    assert days["2024-02-29"].date_key == 20240229
    assert days["2024-02-29"].month_name_it == "Febbraio"
    assert (days["2023-12-31"].season, days["2024-02-29"].season, days["2024-03-01"].season) == (
        "Inverno", "Inverno", "Primavera",
    )


def test_calendar_covers_horizon(build):
    star = build([sale(1, "2024-01-01"), sale(2, "2024-01-10")])
    row = quality.calendar_cover(star).first()
    assert row.days_beyond == 90 and row.is_covered == 1
    assert star.dim_date.count() == 100


def test_date_key_round_trip(spark):
    frame = spark.sql("SELECT explode(sequence(DATE'2023-12-25', DATE'2024-03-05')) AS d")
    assert frame.where(date_of_key(date_key(F.col("d"))) != F.col("d")).count() == 0


def test_rounding(spark):
    values = [(0.125,), (0.135,), (2.675,), (-0.125,), (-0.0,), (1.005,), (0.5,), (-0.5,)]
    rows = spark.createDataFrame(values, "v double").select(
        round_cents(F.col("v")).alias("even"), round_half_up(F.col("v"), 0).alias("up")
    ).collect()
    assert [r.even for r in rows[:4]] == [0.12, 0.14, 2.68, -0.12]
    assert str(rows[4].even) == "0.0"
    assert [r.up for r in rows[6:]] == [1.0, -1.0]


def test_rounding_equals_numpy(spark):
    values = np.round(np.random.default_rng(1).uniform(-5000, 5000, 20000), 3)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    rounded = [r.r for r in frame.select(round_cents(F.col("v")).alias("r")).collect()]
    np.testing.assert_array_equal(rounded, values.round(2))


def test_return_reverses_the_sale(build):
    star = build(
        [
            sale(1, "2024-01-01", quantity=3, discount=0.1),
            sale(2, "2024-01-01", quantity=2, is_return=1),
            sale(3, "2024-01-01", quantity=1, discount=1.0, is_return=1),
        ]
    )
    rows = {r.sale_key: r for r in star.fact_sales().collect()}
    assert (rows[1].gross_sales, rows[1].discount_amount, rows[1].net_sales) == (30.0, 3.0, 27.0)
    assert (rows[1].cost_amount, rows[1].gross_margin, rows[1].quantity) == (12.0, 15.0, 3)
    free = rows[2]  # a return without discount
    assert (free.quantity, free.net_sales, free.cost_amount) == (-2, -20.0, -8.0)
    assert str(free.discount_amount) == "0.0"
    assert rows[3].net_sales == 0.0
    check = quality.returns_sign(star).first()
    assert (check.return_lines, check.positive_returns) == (2, 0)


def test_surrogate_keys_follow_natural_ids(build):
    star = build([sale(1, "2024-01-01", product="P3")])
    assert {r.product_id: r.product_key for r in star.dim_product.collect()} == {
        "P1": 1, "P2": 2, "P3": 3,
    }
    assert star.fact_sales().first().product_key == 3


def test_unknown_references_are_rejected_with_reason(build, tmp_path):
    star = build(
        [
            sale(1, "2024-01-01"),
            sale(2, "2024-01-02", product="P9"),
            sale(3, "2024-01-03", store="S9", customer="C9"),
        ]
    )
    assert {r.transaction_id: r.missing for r in star.rejects().collect()} == {
        2: "product", 3: "store,customer",
    }
    assert {r.dimension: r.orphans for r in quality.orphans(star).collect()} == {
        "dim_product": 1, "dim_store": 1, "dim_customer": 1, "dim_date": 0,
    }
    with pytest.raises(warehouse.LoadError, match="lookup"):
        warehouse.write_star(star, str(tmp_path / "a"))
    written = warehouse.write_star(star, str(tmp_path / "b"), str(tmp_path / "rejects"))
    assert [r.sale_key for r in written.fact_sales().collect()] == [1]
    assert star.spark.read.parquet(str(tmp_path / "rejects/lookup")).count() == 2


def test_duplicate_ids_stop_the_load(build, tmp_path):
    star = build([sale(1, "2024-01-01")], products=[*PRODUCTS, PRODUCTS[0]])
    checks = {
        r.column_name: r.duplicate_count
        for r in quality.dimension_constraints("product", star.dim_product).collect()
    }
    assert checks == {"product_key": 0, "product_id": 1}
    with pytest.raises(warehouse.LoadError, match="dim_product"):
        warehouse.write_star(star, str(tmp_path))


def test_row_order_of_the_extract_does_not_matter(build):
    sales = [sale(i, f"2024-01-{1 + i % 20:02d}", quantity=1 + i % 3) for i in range(1, 60)]
    first = build(sales).fact_sales().collect()
    second = build(sales[::-1]).fact_sales().collect()
    assert sorted(first) == sorted(second)
