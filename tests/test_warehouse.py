"""Reading extracts, writing and reading the warehouse, refresh, marts and the pipeline."""

from __future__ import annotations

import pytest
from conftest import CUSTOMERS, PRODUCTS, STORES, day, sale

from salesmart import jobs, schema
from salesmart.functions.calendar import Period
from salesmart.operators import anomalies, quality, scenario
from salesmart.plans import analytics, kpis, reports
from salesmart.plans.star import ExtractStar, WarehouseStar
from salesmart.sources import extracts, snapshots, warehouse

SALES = [
    sale(1, "2024-01-05"),
    sale(2, "2024-02-10", quantity=2),
    sale(3, "2024-02-20", product="P2", store="S2", price=100.0),
    sale(4, "2024-03-15", quantity=3, is_return=1),
]


def write_csv(folder, name, struct, rows):
    lines = [",".join(struct.names)]
    lines += [",".join("" if v is None else str(v) for v in row) for row in rows]
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture
def csv_folder(tmp_path):
    write_csv(tmp_path, "products", schema.PRODUCTS, PRODUCTS)
    write_csv(tmp_path, "stores", schema.STORES, STORES)
    write_csv(tmp_path, "customers", schema.CUSTOMERS, CUSTOMERS)
    write_csv(tmp_path, "transactions", schema.TRANSACTIONS, SALES)
    return tmp_path


def test_csv_extracts_give_the_same_fact(spark, build, csv_folder):
    star = ExtractStar(spark, extracts.read_extracts(spark, str(csv_folder)))
    assert star.fact_sales().schema.simpleString() == build(SALES).fact_sales().schema.simpleString()
    assert sorted(star.fact_sales().collect()) == sorted(build(SALES).fact_sales().collect())
    assert star.extracts.corrupt.count() == 0


def test_parquet_extracts(spark, csv_folder, tmp_path):
    source = extracts.read_extracts(spark, str(csv_folder))
    for name in ["products", "stores", "customers"]:
        getattr(source, name)().write.parquet(str(tmp_path / "pq" / name))
    source.lines(set()).write.parquet(str(tmp_path / "pq" / "transactions"))
    star = ExtractStar(spark, extracts.read_extracts(spark, str(tmp_path / "pq"), "parquet"))
    assert star.fact_sales().count() == 4


def test_unreadable_records_stop_the_load(spark, csv_folder, tmp_path):
    with open(csv_folder / "transactions.csv", "a") as file:
        file.write("5,2024-99-99,P1,S1,C1,1,0.0,0,10.0\n")
        file.write("6,2024-01-06,P1,S1,C1,many,0.0,0,10.0\n7,2024-01-07,P1\n")
    star = ExtractStar(spark, extracts.read_extracts(spark, str(csv_folder)))
    assert {r.extract for r in star.extracts.corrupt.collect()} == {"transactions"}
    assert star.extracts.corrupt.count() == 3
    assert star.sales("date").count() == 4
    with pytest.raises(warehouse.LoadError, match="corrupt"):
        warehouse.write_star(star, str(tmp_path / "a"))
    written = warehouse.write_star(star, str(tmp_path / "b"), str(tmp_path / "rejects"))
    assert written.fact_sales().count() == 4
    assert spark.read.parquet(str(tmp_path / "rejects/corrupt")).count() == 3


def test_profile_of_an_extract(build):
    rows = extracts.profile(build(SALES).extracts.lines(set()), ["date", "colour"], 3).collect()
    assert {r.column_name: (r.is_present, r.row_count, r.has_enough_rows) for r in rows} == {
        "date": (1, 4, 1), "colour": (0, 4, 1),
    }


def test_written_star_answers_like_the_extracts(build, tmp_path):
    star = build(SALES)
    written = warehouse.write_star(star, str(tmp_path))
    assert sorted(written.fact_sales().collect()) == sorted(star.fact_sales().collect())
    for query in [
        kpis.kpi_base, kpis.new_returning, analytics.rfm_segments, analytics.monthly_yoy,
        reports.product_matrix, reports.loyalty_age_sales, quality.orphans, quality.load_audit,
        quality.calendar_cover,
    ]:
        assert sorted(query(written).collect(), key=str) == sorted(query(star).collect(), key=str)
    nulls = quality.constraints(written).where("null_count + duplicate_count > 0")
    assert nulls.count() == 0
    assert {r.table_name: r.row_count for r in quality.load_audit(written).collect()} == {
        "dim_date": 71 + 90, "dim_product": 3, "dim_store": 2, "dim_customer": 7, "fact_sales": 4,
    }


def test_sql_over_the_tables(spark, build, tmp_path):
    written = warehouse.write_star(build(SALES), str(tmp_path))
    written.register_views()
    rows = spark.sql(
        "SELECT p.category, count(*) AS n, cast(sum(f.net_sales) AS decimal(18,2)) AS net "
        "FROM fact_sales f JOIN dim_product p USING (product_key) "
        "JOIN dim_date d USING (date_key) JOIN dim_store s USING (store_key) "
        "JOIN dim_customer c USING (customer_key) WHERE d.year = 2024 GROUP BY p.category"
    ).collect()
    assert [(r.category, r.n, float(r.net)) for r in rows] == [("Home", 4, 100.0)]


def test_period_prunes_partitions(build, tmp_path):
    written = warehouse.write_star(build(SALES), str(tmp_path))
    february = Period(day("2024-02-01"), day("2024-02-29"))
    lines = written.sales("net_sales", during=february)
    assert sorted(r.net_sales for r in lines.collect()) == [20.0, 100.0]
    plan = lines._jdf.queryExecution().toString()
    assert "year_month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date_key" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_refresh_replaces_only_the_touched_months(build, tmp_path):
    path = str(tmp_path)
    warehouse.write_star(build(SALES), path)
    changed = [
        sale(1, "2024-01-05", quantity=9),  # outside the refresh, must not be read again
        sale(2, "2024-02-11", quantity=5),
        sale(7, "2024-02-28", quantity=6),
    ]
    star = build(changed)
    months = warehouse.refresh(star, path, Period(day("2024-02-15"), day("2024-03-02")))
    assert months == [202402, 202403]
    rows = warehouse.read_star(star.spark, path).fact_sales().collect()
    assert sorted((r.date_key, r.quantity) for r in rows) == [
        (20240105, 1), (20240211, 5), (20240228, 6),
    ]
    keys = {r.date_key: r.sale_key for r in rows}
    assert keys == {20240105: 1, 20240211: 2, 20240228: 3}


def test_refresh_keeps_keys_and_takes_in_new_members(spark, build, tmp_path):
    """A new id between known ones, a changed and a vanished member, and a later last day."""
    path = str(tmp_path)
    first, third, second = PRODUCTS[0], PRODUCTS[2], PRODUCTS[1]
    gone = ("P0", "Old", "Home", "Light", "Vela", 1.0, 1.0)
    warehouse.write_star(
        build([sale(1, "2024-01-05", "P1"), sale(2, "2024-01-06", "P3", price=5.0), sale(3, "2024-01-07", "P0")],
              products=[gone, first, third]),
        path,
    )
    renamed = ("P1", "Lantern", *first[2:])
    star = build(
        [sale(4, "2024-02-01", "P3", price=5.0), sale(5, "2024-02-02", "P2", price=100.0), sale(6, "2024-06-30", "P1")],
        products=[renamed, second, third],
    )
    warehouse.refresh(star, path, Period(day("2024-02-01"), day("2024-06-30")))
    after = warehouse.read_star(spark, path)
    keys = {r.product_id: r.product_key for r in after.dim_product.collect()}
    assert keys == {"P0": 1, "P1": 2, "P3": 3, "P2": 4}
    assert quality.orphans(after).where("orphans > 0").count() == 0
    assert quality.calendar_cover(after).first().is_covered == 1
    sold = after.sales("product_id", "product_name", "net_sales").collect()
    assert sorted(map(tuple, sold)) == [
        ("P0", "Old", 10.0), ("P1", "Lantern", 10.0), ("P1", "Lantern", 10.0), ("P2", "Sofa", 100.0),
        ("P3", "Ball", 5.0), ("P3", "Ball", 5.0),
    ]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    struct = schema.STORES
    rows = [("S1", "North", "Milano", "Lombardia", "Flagship", "2015-01-01")]
    shuffled = ["region", "city", "store_id", "extra", "open_date", "store_type", "store_name"]
    text = dict(zip(struct.names, rows[0], strict=True)) | {"extra": "x"}
    (tmp_path / "stores.csv").write_text(",".join(shuffled) + "\n" + ",".join(text[c] for c in shuffled) + "\n")
    good, bad = extracts.read_csv(spark, str(tmp_path / "stores.csv"), struct)
    assert [tuple(map(str, r)) for r in good.collect()] == rows and bad.count() == 0
    (tmp_path / "less.csv").write_text("store_id,city\nS1,Milano\n")
    with pytest.raises(ValueError, match="store_name"):
        extracts.read_csv(spark, str(tmp_path / "less.csv"), struct)
    frame = good.select("store_id", "region")
    found = extracts.profile(frame, ["store_id", "region"], 0, extracts.csv_header(spark, str(tmp_path / "less.csv"))).collect()
    assert {r.column_name: r.is_present for r in found} == {"store_id": 1, "region": 0}


def test_a_scenario_is_a_whole_star(spark, build):
    star = build(SALES)
    changed = scenario.spike(star, Period(day("2024-01-01"), day("2024-12-31")), 2)
    fact = changed.fact_sales().collect()
    assert sorted(r.sale_key for r in fact) == list(range(1, changed.sales("date").count() + 1))
    assert quality.orphans(changed).where("orphans > 0").count() == 0
    changed.register_views("what_if_")
    assert spark.sql("SELECT count(*) FROM what_if_fact_sales").first()[0] == len(fact)


def test_marts_keep_their_types_and_report_bad_values(spark, build, tmp_path):
    written = warehouse.write_star(build(SALES), str(tmp_path / "w"))
    warehouse.export_marts(written, str(tmp_path / "m"))
    clean, bad = warehouse.read_mart(spark, str(tmp_path / "m"), "fact_sales")
    assert sorted(clean.collect()) == sorted(written.fact_sales().collect())
    assert bad.count() == 0
    text = spark.createDataFrame([("2024-01-01", "1.5"), ("soon", "2"), (None, "x")], "d string, v string")
    types = {"d": "date", "v": "double"}
    good, rejected = quality.typed_or_rejected(text, types)
    assert good.count() == 1 and rejected.count() == 2
    counts = {r.column_name: (r.filled, r.rejected) for r in quality.type_check(text, types).collect()}
    assert counts == {"d": (2, 1), "v": (3, 1)}


def test_pipeline(spark, tiny, tmp_path):
    """Extracts to marts in one go; the integrity checks on the result."""
    result = jobs.run_all(tiny, str(tmp_path))
    assert result["rows"]["fact_sales"] == 6000
    assert result["forecast"]["horizon_days"] == 90
    assert result["anomalies"]["anomalies"] >= 1
    written = warehouse.read_star(spark, str(tmp_path / "warehouse"))
    assert quality.orphans(written).where("orphans > 0").count() == 0
    assert quality.returns_sign(written).first().positive_returns == 0
    assert quality.calendar_cover(written).first().is_covered == 1
    forecast, bad = warehouse.read_mart(spark, str(tmp_path / "marts"), "forecast_daily")
    check = quality.forecast_checks(forecast, 90).first()
    assert (check.is_horizon, check.outside_band, bad.count()) == (1, 0, 0)
    found, bad = warehouse.read_mart(spark, str(tmp_path / "marts"), "anomalies")
    check = quality.anomaly_checks(found).first()
    assert (check.bad_flags, check.bad_directions, check.has_anomaly) == (0, 0, 1)
    assert bad.count() == 0 and found.count() == result["anomalies"]["store_days"]


FIRST = [sale(1, "2024-01-05", customer="C1"), sale(2, "2024-02-10", quantity=2), sale(3, "2024-02-20", product="P2", store="S2", price=100.0)]
LATER = [sale(4, "2024-02-21", customer="C2", quantity=7), sale(5, "2024-03-02", customer="C3")]
FEBRUARY_MARCH = Period(day("2024-02-01"), day("2024-03-31"))


def contents(star):
    return {name: sorted(frame.collect(), key=str) for name, frame in star.tables.items()}


@pytest.mark.parametrize("fails_at", ["write_months", "commit"])
def test_a_refresh_that_fails_leaves_the_old_version(spark, build, tmp_path, monkeypatch, fails_at):
    path = str(tmp_path)
    warehouse.write_star(build(FIRST), path)
    before = contents(warehouse.read_star(spark, path))

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(snapshots, fails_at, fail)
    with pytest.raises(OSError, match="lost"):
        warehouse.refresh(build(LATER), path, FEBRUARY_MARCH)
    monkeypatch.undo()
    assert list((tmp_path / "dim_date").glob("commit=*"))[1:]  # the dimensions had been written
    after = warehouse.read_star(spark, path)
    assert contents(after) == before and snapshots.versions(spark, path) == [1]
    assert quality.orphans(after).where("orphans > 0").count() == 0
    gone = snapshots.remove_versions(spark, path)
    assert any(g.startswith("dim_date/") for g in gone) and contents(after) == before
    assert warehouse.refresh(build(LATER), path, FEBRUARY_MARCH) == [202402, 202403]
    assert snapshots.versions(spark, path) == [1, 2]


def test_a_reader_keeps_its_version(spark, build, tmp_path):
    path = str(tmp_path)
    held = warehouse.write_star(build(FIRST), path)
    before = contents(held)
    lines = held.sales("date", "net_sales", "customer_id", "store_name")
    warehouse.refresh(build(LATER), path, FEBRUARY_MARCH)
    warehouse.write_star(build(LATER), path)
    assert contents(held) == before and lines.count() == 3
    assert contents(warehouse.read_star(spark, path, version=1)) == before
    assert snapshots.versions(spark, path) == [1, 2, 3]
    second = contents(warehouse.read_star(spark, path, version=2))
    gone = snapshots.remove_versions(spark, path, keep=2)
    assert any(g.startswith("manifests/") for g in gone)
    # version 2 still needs January as version 1 wrote it
    assert contents(warehouse.read_star(spark, path, version=2)) == second
    with pytest.raises(snapshots.NoVersion):
        warehouse.read_star(spark, path, version=1)
    assert snapshots.remove_versions(spark, path, keep=2) == []


def test_two_writers_of_one_version(spark, build, tmp_path):
    path = str(tmp_path)
    warehouse.write_star(build(FIRST), path)
    manifest = snapshots.read_manifest(spark, path)
    snapshots.commit(spark, path, manifest)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        snapshots.commit(spark, path, manifest)
    with pytest.raises(snapshots.NoVersion):
        warehouse.read_star(spark, str(tmp_path / "elsewhere"))


def test_kept_totals_equal_the_lines(spark, build, tmp_path):
    """After a late correction, a deleted month and a full load, every kept sum is that of the lines."""
    path = str(tmp_path)
    star = build(SALES)
    warehouse.write_star(star, path)
    corrected = [sale(2, "2024-02-10", quantity=5, customer="C7"), sale(9, "2024-02-29", store="S2", discount=0.1)]
    deleted = [sale(10, "2024-04-02")]
    steps = [(corrected, Period(day("2024-02-01"), day("2024-02-29"))), (deleted, Period(day("2024-03-01"), day("2024-04-30")))]
    for lines, period in steps:
        warehouse.refresh(build(lines), path, period)
        kept = warehouse.read_star(spark, path)
        assert "day_totals" in kept.tables
        plain = WarehouseStar(spark, {n: kept.tables[n] for n in schema.STAR_TABLES}, kept.settings)
        for query in [
            kpis.kpi_yoy, kpis.kpi_mom, kpis.rolling_months, kpis.sales_to_date, kpis.kpi_yoy_daily, kpis.new_returning,
            kpis.kpi_labels, reports.store_yoy, reports.exec_trend, analytics.monthly_yoy, anomalies.anomalies,
            lambda s: kpis.kpi(s, ["region", "year"], ["total_net_sales", "total_quantity", "return_rate_pct"]),
            lambda s: kpis.kpi(s, ["store_name"], ["gross_margin_pct"], {"month": [2, 4]}, Period(day("2024-02-02"), day("2024-04-30"))),
        ]:
            assert sorted(query(kept).collect(), key=str) == sorted(query(plain).collect(), key=str)
    months = {r.ym: r.customer_count for r in kpis.new_returning(kept).collect()}
    assert months == {"2024-01": 1, "2024-02": 2, "2024-04": 1}


def test_a_refresh_reads_no_line_outside_its_period(spark, build, tmp_path):
    """The other months' files may even be gone; time intelligence reads totals only."""
    path = str(tmp_path)
    first = warehouse.write_star(build(SALES), path)
    january = list((tmp_path / "fact_sales").glob("commit=*/year_month=202401"))
    (january[0]).rename(tmp_path / "elsewhere")
    warehouse.refresh(build(LATER), path, FEBRUARY_MARCH)
    (tmp_path / "elsewhere").rename(january[0])
    kept = warehouse.read_star(spark, path)
    assert kept.fact_sales().count() == 3
    files = kpis.rolling_months(kept).inputFiles()
    assert files and not any("/fact_sales/" in f for f in files)
    assert not any("/fact_sales/" in f for f in kpis.new_returning(first).inputFiles())
