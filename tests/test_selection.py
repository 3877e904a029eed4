"""Tiles by selection, sets of customers as bits, integrity in one scan: equal to the plain ways, with the plans meant."""

from __future__ import annotations

import random
import re

import pytest
from conftest import sale
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.functions import bitmaps
from salesmart.operators import quality, ranking, security, selection
from salesmart.plans import analytics, kpis
from salesmart.plans.star import ViewStar


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("leaf", [selection.LEAF_ROWS, 40])
def test_tiles_equal_ntile(spark, monkeypatch, leaf):
    """Many ties, values over the whole range of a long, keys of both signs, more or fewer rows than tiles."""
    monkeypatch.setattr(selection, "LEAF_ROWS", leaf)
    monkeypatch.setattr(selection, "CELLS", 16 if leaf == 40 else selection.CELLS)
    draw = random.Random(4)
    for rows in (0, 1, 3, 5, 997):
        data = [
            (k, draw.choice([7, 7, 7, draw.randrange(5)]), draw.choice([-(1 << 63), (1 << 63) - 1, draw.randrange(-9, 9), draw.randrange(1 << 62)]), draw.randrange(10**6))
            for k in draw.sample(range(-(10**9), 10**9), rows)
        ]
        frame = spark.createDataFrame(data, "key long, a long, b long, c long")
        tiled = selection.add_tiles(frame, {"ta": F.col("a"), "tb": F.col("b"), "tc": -F.col("c")}, "key", 5)
        for name, order in (("ta", F.asc("a")), ("tb", F.asc("b")), ("tc", F.desc("c"))):
            tiled = tiled.withColumn(f"e{name}", F.ntile(5).over(Window.orderBy(order, "key")))
        assert tiled.count() == rows
        assert tiled.where("ta <> eta OR tb <> etb OR tc <> etc").count() == 0


def test_tiles_of_a_key_that_is_not_unique(spark, monkeypatch):
    monkeypatch.setattr(selection, "LEAF_ROWS", 10)
    with pytest.raises(ValueError, match="unique"):
        selection.add_tiles(spark.range(100).select(F.lit(1).alias("key"), F.lit(2).alias("v")), {"t": F.col("v")}, "key", 5)
    # a row without a key comes first of its value
    rows = spark.createDataFrame([(None, 1), (1, 1), (2, 1)], "key long, v long")
    tiled = selection.add_tiles(rows, {"t": F.col("v")}, "key", 3)
    assert sorted((r.key or 0, r.t) for r in tiled.collect()) == [(0, 1), (1, 2), (2, 3)]


def test_scores_write_the_customers_once_and_sort_nothing(tiny, monkeypatch):
    written = []
    real = ranking.written
    monkeypatch.setattr(analytics, "written", lambda frame: written.append(plan_of(frame)) or real(frame))
    scores = analytics.rfm_scores(tiny)
    assert len(written) == 1 and "Sort" not in written[0] and "Sort" not in plan_of(scores)


def test_sets_of_customers_merge_exactly(spark):
    """Random keys of both signs and null, merged over random groups, against distinct counts."""
    draw = random.Random(5)
    rows = [(draw.choice("abc"), draw.randrange(4), draw.choice([None, draw.randrange(-300, 300), draw.randrange(1 << 62)])) for _ in range(4000)]
    frame = spark.createDataFrame(rows, "g string, h int, key long")
    key = F.col("key")
    sets = frame.groupBy("g", "h", bitmaps.word_of(key).alias("word")).agg(bitmaps.merged(bitmaps.bit_of(key)).alias("bits"))
    for by in (["g", "h"], ["g"], ["h"], []):
        union = sets.groupBy(*by, "word").agg(bitmaps.merged(F.col("bits")).alias("bits"))
        counted = union.groupBy(*by).agg(bitmaps.members(F.col("bits")).alias("n"))
        plain = frame.groupBy(*by).agg(F.count_distinct("key").alias("n"))
        assert sorted(counted.collect(), key=str) == sorted(plain.collect(), key=str)


def test_measures_read_the_lines_once(tiny):
    for frame in (
        kpis.kpi_base(tiny),
        kpis.kpi_rollup(tiny, ["category", "year"], ["total_net_sales", "customer_count"]),
        kpis.new_returning(tiny),
    ):
        assert len(re.findall(r"Relation \[[^]]*l_orderkey", plan_of(frame))) == 1


def test_rollup_counts_a_customer_once(build):
    star = build([
        sale(1, "2024-01-05", "P1", customer="C1"), sale(2, "2024-02-05", "P3", customer="C1", price=5.0),
        sale(3, "2024-02-06", "P3", customer="C2", price=5.0), sale(4, "2025-02-06", "P1", customer="C1"),
    ])
    rows = kpis.kpi_rollup(star, ["category", "year"], ["customer_count", "sales_line_count", "total_net_sales"]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [
            (0, None, None, 2, 4, 30.0), (1, "Home", None, 1, 2, 20.0), (1, "Sport", None, 2, 2, 10.0),
            (2, "Home", 2024, 1, 1, 10.0), (2, "Home", 2025, 1, 1, 10.0), (2, "Sport", 2024, 2, 2, 10.0),
        ],
        key=str,
    )
    empty = kpis.kpi(build([]), [], ["sales_line_count", "customer_count", "total_net_sales"]).collect()
    assert [tuple(r) for r in empty] == [(0, 0, None)]


def test_integrity_reads_the_lines_once(tiny):
    for check in (quality.orphans, quality.lookup_audit):
        assert len(re.findall(r"Relation \[[^]]*l_partkey", plan_of(check(tiny)))) == 1 + (check is quality.orphans)  # the calendar's span
    lines = plan_of(quality._line_checks(tiny))
    assert len(re.findall(r"Relation \[[^]]*l_partkey", lines)) == 1


def test_integrity_counts_null_and_repeated_references(build):
    from conftest import CUSTOMERS, PRODUCTS

    lines = [sale(1, "2024-01-05", "P1"), sale(2, "2024-01-05", None), sale(3, "2024-01-06", "P9", customer="C99"), sale(3, "2024-01-06", "P9", customer="C99")]
    star = build(lines, products=[*PRODUCTS, PRODUCTS[0]], customers=CUSTOMERS)
    found = {r.dimension: r.orphans for r in quality.orphans(star).collect()}
    assert found == {"dim_product": 3, "dim_store": 0, "dim_customer": 2, "dim_date": 0}
    audit = quality.lookup_audit(star).first()
    assert (audit.line_count, audit.missing_product, audit.missing_store, audit.missing_customer) == (4, 3, 0, 2)
    checks = {r.column_name: (r.null_count, r.duplicate_count) for r in quality._line_checks(star).collect()}
    assert checks["product_id"] == (1, 0) and checks["sale_key"] == (0, 1)
    empty = {r.dimension: r.orphans for r in quality.orphans(build([])).collect()}
    assert set(empty.values()) == {0}


def test_a_line_keeps_its_key_under_every_role(spark, build):
    lines = [sale(i, f"2024-0{1 + i % 3}-{10 + i}", store=("S1", "S2")[i % 2], customer=f"C{1 + i % 5}") for i in range(8)]
    star = build(lines)
    keys = {tuple(r)[1:]: r.sale_key for r in star.fact_sales().collect()}
    mapping = spark.createDataFrame([("a@x", "Campania"), ("b@x", "Campania"), ("b@x", "Lombardia"), ("b@x", "Lombardia")], "email string, region string")
    many = spark.range(100_000).select(F.concat(F.lit("C"), F.col("id") * 2).alias("customer_id"))
    for view, n in (
        (security.as_user(star, "a@x", mapping), 4), (security.as_user(star, "b@x", mapping), 8), (security.as_user(star, "no@x", mapping), 0),
        (security.as_region(star, "Lombardia"), 4), (ViewStar(star, {"customer_id": many}), 3), (security.sliced(star, {"month": [1, 3], "region": "Lombardia"}), 3),
    ):
        seen = view.fact_sales().collect()
        assert len(seen) == n == view.sales("date").count()
        assert {tuple(r)[1:]: r.sale_key for r in seen}.items() <= keys.items()
        assert kpis.kpi(view, [], ["sales_line_count"]).first()[0] == n
    assert ViewStar(star, {"customer_id": many}).dim_customer.count() == 3


def test_as_user_collects_nothing(tiny, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "collect", lambda self: pytest.fail("collected"))
    plan = plan_of(security.as_user(tiny, "nation_7@example.com", tiny.extracts.user_region()).sales("region", "net_sales"))
    assert "LeftSemi" in plan


@pytest.mark.parametrize("limit", ["20k", "-1"])  # the roles' source is below the first; its joins are estimated above
def test_a_role_does_not_gather_a_region_in_one_task(tiny, limit):
    conf, known = tiny.spark.conf, tiny.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = kpis.kpi(security.as_user(tiny, "nation_7@example.com", tiny.extracts.user_region()), ["region", "year"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        conf.set("spark.sql.autoBroadcastJoinThreshold", known)
    assert "LeftSemi" in plan and not re.search(r"SortMergeJoin \[region#\d+\]", plan)
    expected = kpis.kpi(security.as_region(tiny, rows[0].region), ["region", "year"]).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, expected))
