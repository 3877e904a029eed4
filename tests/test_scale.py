"""The paths taken on large tables give the same results as the simple ones."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from conftest import TESTDATA
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from compare import connect, difference
from salesmart.operators import lookup, ranking
from salesmart.operators.numbering import number_lines
from salesmart.plans.star import ExtractStar
from salesmart.sources.order_tables import order_table_extracts

SF_DIR = f"{TESTDATA}/sf0.001"
LOOKUP_QUERIES = [
    "category_share", "dq_orphans", "fact_sales", "kpi_sliced", "loyalty_age_sales",
    "product_matrix", "rfm_segments", "rls_dynamic", "store_daily", "store_rank",
]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", LOOKUP_QUERIES)
def test_shuffled_lookups_equal_sql(spark, con, no_broadcast, name):
    problem, _, _, _ = difference(
        spark, con, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR
    )
    assert problem is None, problem


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_leaves_the_shuffle(spark, no_broadcast, how):
    """A third of the lines on one key, one key unknown to the dimension, and null keys."""
    lines = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 100 == 1, None)
        .when(F.col("id") % 5 == 1, 5000)
        .otherwise(F.col("id") % 400)
        .alias("key"),
        F.col("id").alias("line"),
    )
    dim = spark.range(400).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = lookup.attach(lines, dim, "key", how).select("key", "line", "twice")
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    keys = {r.line: r.key for r in lines.collect()}
    known = {i: (k, 2 * k) if k is not None and k < 400 else (k, None) for i, k in keys.items()}
    expected = [(k, i, t) for i, (k, t) in known.items() if how == "left" or t is not None]
    assert Counter(map(tuple, rows)) == Counter(expected)


def test_lookups_scan_the_lines_once(spark, no_broadcast):
    """Three large dimensions cost three joins and one scan of the lines, whatever is hot."""
    query = entry_points.queries()["fact_sales"]
    star = ExtractStar(spark, order_table_extracts(spark, SF_DIR))
    lines = star.sales("date", "category", "region", "loyalty_tier", "net_sales")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate") and plan.count("lineitem") <= 1
    assert len(re.findall(r"Relation \[[^]]*l_orderkey", plan)) == 1
    assert query(spark, SF_DIR).count() > 0


def test_broadcast_only_below_the_threshold(spark):
    limit = lookup.broadcast_limit(spark.range(1))
    assert limit == 10 * 1024 * 1024
    for text, size in [("-1", -1), ("64MB", 64 << 20), ("1g", 1 << 30), ("512kb", 512 << 10)]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert lookup.broadcast_limit(spark.range(1)) == size
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))


def test_positions_tiles_and_ranks_equal_windows(spark):
    rows = spark.range(5003).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("value"),
    )
    order = [F.asc("value"), F.asc("key")]
    window = Window.orderBy(*order)
    placed = ranking.with_position(rows, order, "position")
    same = placed.withColumn("expected", F.row_number().over(window))
    assert same.where("position != expected").count() == 0
    for tiles in (5, 7):
        tiled = ranking.add_tile(rows, order, tiles, "tile")
        wrong = tiled.withColumn("expected", F.ntile(tiles).over(window))
        assert wrong.where("tile != expected").count() == 0
    ranked = ranking.add_rank(rows, "value", "key", "place")
    wrong = ranked.withColumn("expected", F.rank().over(Window.orderBy(F.desc("value"))))
    assert wrong.count() == 5003 and wrong.where("place != expected").count() == 0


def test_tiles_of_fewer_rows_than_tiles(spark):
    rows = spark.range(3).select(F.col("id").alias("key"))
    tiled = ranking.add_tile(rows, [F.asc("key")], 5, "tile")
    assert sorted(r.tile for r in tiled.collect()) == [1, 2, 3]


def test_numbering_splits_a_hot_day(spark):
    """A third of the lines on one day, many sort ranges: numbers are those of a plain sort."""
    lines = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.to_date(F.lit("2024-01-15")))
        .otherwise(F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") % 60).cast("int")))
        .alias("date"),
        F.col("id").alias("line"),
    )
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = number_lines(lines.repartition(7), ["line"], "number", after=10).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plain = sorted((r.date, r.line) for r in lines.collect())
    assert sorted((r.number, r.date, r.line) for r in rows) == [
        (11 + i, *row) for i, row in enumerate(plain)
    ]


def test_plans(tiny):
    """Pruned scans, pushed filters, one sort for both rolling windows, no cross product."""
    plan = lambda df: df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    daily = plan(entry_points.queries()["daily_sales"](tiny.spark, SF_DIR))
    scan = next(line for line in daily.splitlines() if "l_shipdate" in line and "ReadSchema" in line)
    for column in ["l_tax", "l_extendedprice", "l_orderkey", "l_suppkey", "l_linestatus"]:
        assert column not in scan
    assert "orders" not in daily
    sliced = plan(entry_points.queries()["kpi_sliced"](tiny.spark, SF_DIR))
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in sliced
    for name in ["anomalies", "store_daily_dense", "exec_cards", "rfm_matrix", "scenario_dip"]:
        text = plan(entry_points.queries()[name](tiny.spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    scored = plan(entry_points.queries()["anomalies"](tiny.spark, SF_DIR))
    assert scored.count("Exchange hashpartitioning(store_key") == 1


def test_written_tables_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranking, "shared_folder", lambda session: str(tmp_path))
    assert ranking.written(spark.range(3)).count() == 3
    assert len(list(tmp_path.glob("salesmart-*"))) == 1
