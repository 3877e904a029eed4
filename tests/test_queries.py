"""Edge semantics of the queries on hand-made rows."""

from __future__ import annotations

import datetime

from conftest import STORES, day, sale
from pyspark.sql import functions as F

from salesmart.functions.calendar import Period
from salesmart.functions.measures import margin_status, trend_label
from salesmart.operators import security
from salesmart.plans import analytics, kpis, reports


def months(start: int, count: int, skip=()):
    return [
        sale(i, f"{start + i // 12}-{1 + i % 12:02d}-05", quantity=i + 1)
        for i in range(count)
        if i not in skip
    ]


def test_positional_lag_and_calendar_year_ago_differ_on_a_gap(build):
    star = build(months(2022, 26, skip={3}))
    positional = {r.ym: r.net_sales_py for r in analytics.monthly_yoy(star).collect()}
    calendar = {r.ym: r.sales_py for r in kpis.kpi_yoy(star).collect()}
    assert calendar["2023-01"] == 10.0 and calendar["2023-04"] is None
    assert positional["2023-01"] is None and positional["2023-02"] == 10.0
    assert calendar["2023-02"] == 20.0


def test_rolling_months_count_missing_months(build):
    star = build(months(2022, 6, skip={3}))
    rolled = {r.ym: r.rolling_3m for r in kpis.rolling_months(star).collect()}
    assert rolled["2022-05"] == 30.0 + 50.0
    prior = {r.ym: r.sales_pm for r in kpis.kpi_mom(star).collect()}
    assert prior["2022-05"] is None and prior["2022-06"] == 50.0


def test_calendar_rows_without_sales(build):
    """Gap months, and days and months after the last sale, have rows of their own."""
    star = build([sale(1, "2023-02-10"), sale(2, "2024-01-05"), sale(3, "2024-03-05", quantity=2)])
    months = {r.ym: r for r in kpis.monthly_time_intelligence(star).collect()}
    assert len(months) == 17  # to the end of the calendar, 90 days after the last sale
    gap = months["2024-02"]
    assert (gap.net_sales, gap.sales_py, gap.sales_pm, gap.rolling_3m) == (None, 10.0, 10.0, 10.0)
    assert (gap.sales_yoy, gap.sales_yoy_pct, gap.sales_mom_pct) == (-10.0, -1.0, -1.0)
    assert months["2024-06"].rolling_12m == 30.0 and months["2024-06"].sales_yoy is None
    days = {r.date.isoformat(): r for r in kpis.sales_to_date(star).collect()}
    assert days["2024-03-31"].sales_ytd == 30.0 and days["2024-03-31"].net_sales is None
    assert days["2024-04-01"].sales_mtd is None and days["2024-01-04"].sales_ytd is None
    assert reports.exec_cards(star).first().last_month == "2024-03"


def test_leap_day_meets_28_february(build):
    star = build(
        [sale(1, "2023-02-28", quantity=2), sale(2, "2024-02-28"), sale(3, "2024-02-29")]
    )
    rows = {r.date.isoformat(): r.sales_py for r in kpis.kpi_yoy_daily(star).collect()}
    assert rows["2023-02-28"] is None and rows["2024-02-28"] == rows["2024-02-29"] == 20.0
    assert len(rows) == 457  # two leap-day years to the end of the calendar


def test_zero_denominator_is_null(build):
    star = build([sale(1, "2024-01-01"), sale(2, "2024-01-01", is_return=1)])
    row = kpis.kpi(star, ["category"]).first()
    assert row.total_net_sales == 0.0 and row.gross_margin_pct is None
    assert row.return_rate_pct == 0.5 and row.sales_line_count == 2


def test_groups_with_a_null_key_keep_their_customers(build):
    people = [("C1", None, "25-34", "Roma", "Gold", None), ("C2", "F", "25-34", "Roma", "Gold", None)]
    star = build(
        [sale(1, "2024-01-01"), sale(2, "2024-01-02"), sale(3, "2024-01-02", customer="C2")],
        customers=people,
    )
    rows = kpis.kpi(star, ["gender"], ["customer_count", "total_net_sales", "sales_per_customer"])
    assert {r.gender: (r.customer_count, r.total_net_sales, r.sales_per_customer)
            for r in rows.collect()} == {None: (1, 20.0, 20.0), "F": (1, 10.0, 10.0)}


def test_labels(spark):
    rows = spark.createDataFrame(
        [(0.123,), (-0.0449,), (0.0,), (None,), (0.40,), (0.30,)], "v double"
    ).select(trend_label(F.col("v")).alias("t"), margin_status(F.col("v")).alias("m")).collect()
    assert [r.t for r in rows[:4]] == ["▲ 12.3%", "▼ -4.5%", "▲ 0.0%", ""]
    assert [r.m.split()[1] for r in rows[3:]] == ["Low", "Healthy", "Watch"]


def test_rank_leaves_a_gap_after_ties(build):
    stores = [*STORES, ("S3", "West", "Roma", "Lazio", "Outlet", day("2015-01-01"))]
    star = build(
        [
            sale(1, "2024-01-01", store="S1", quantity=2),
            sale(2, "2024-01-01", store="S2", quantity=2),
            sale(3, "2024-01-01", store="S3"),
        ],
        stores=stores,
    )
    assert [(r.store_name, r.sales_rank) for r in analytics.store_rank(star).collect()] == [
        ("North", 1), ("South", 1), ("West", 3),
    ]


def test_ntile_sizes_and_ties(build):
    few = build([sale(i, "2024-01-01", customer=f"C{i}") for i in (1, 2, 3)])
    assert sorted(r.m_score for r in analytics.rfm_scores(few).collect()) == [1, 2, 3]
    tied = build([sale(i, "2024-01-01", customer=f"C{i}") for i in range(1, 8)])
    scores = {r.customer_key: r.m_score for r in analytics.rfm_scores(tied).collect()}
    assert [scores[k] for k in range(1, 8)] == [1, 1, 2, 2, 3, 4, 5]


def test_recency_counts_from_the_end_of_the_calendar(build):
    star = build([sale(1, "2024-01-01", customer="C1"), sale(2, "2024-01-05", customer="C2"),
                  sale(3, "2024-01-09", customer="C3", is_return=1)])
    rows = {r.customer_key: r for r in analytics.rfm_segments(star).collect()}
    assert set(rows) == {1, 2}  # a customer with returns only has no score
    assert rows[1].recency_days == 98 and rows[2].recency_days == 94
    assert rows[2].r_score > rows[1].r_score


def test_moving_average_uses_rows_not_days(build):
    star = build([sale(i, f"2024-01-{d:02d}", quantity=i) for i, d in enumerate([1, 2, 9], 1)])
    assert [r.ma_7d for r in analytics.sales_ma7(star).orderBy("date").collect()] == [10, 15, 20]


def test_new_customers_count_once(build):
    star = build(
        [sale(1, "2024-01-01"), sale(2, "2024-01-20"), sale(3, "2024-02-01"),
         sale(4, "2024-02-02", customer="C2", is_return=1)]
    )
    rows = {r.ym: r for r in kpis.new_returning(star).collect()}
    assert (rows["2024-01"].new_customers, rows["2024-01"].returning_customers) == (1, 0)
    assert (rows["2024-02"].new_customers, rows["2024-02"].returning_customers) == (1, 1)


def test_subtotals_add_up(tiny):
    rows = reports.product_matrix(tiny).collect()
    cents = {level: sum(round(r.net_sales * 100) for r in rows if r.level == level) for level in range(4)}
    assert len({*cents.values()}) == 1
    region = analytics.share_by(tiny, "region")
    assert abs(sum(r.pct_of_total for r in region.collect()) - 100) < 0.5


def test_slicers_and_period(build):
    star = build(
        [sale(1, "2023-12-31"), sale(2, "2024-01-01", quantity=2),
         sale(3, "2024-06-01", store="S2", quantity=4)]
    )
    year = Period(datetime.date(2024, 1, 1), datetime.date(2024, 12, 31))
    rows = kpis.kpi(star, ["year"], ["total_net_sales"], {"region": "Lombardia"}, year).collect()
    assert [tuple(r) for r in rows] == [(2024, 20.0)]
    assert kpis.kpi(star, ["year"], ["total_net_sales"], {"region": "Lazio"}).count() == 0


def test_roles(spark, build):
    star = build([sale(1, "2024-01-01", store="S1"), sale(2, "2024-01-01", store="S2")])
    mapping = spark.createDataFrame(
        [("a@x", "Lombardia"), ("b@x", "Lombardia"), ("b@x", "Campania"), ("b@x", "Campania")],
        "email string, region string",
    )
    seen = lambda user: sorted(
        r.region for r in security.for_user(star, user, mapping, ["region"]).collect()
    )
    assert seen("a@x") == ["Lombardia"]
    assert seen("b@x") == ["Campania", "Lombardia"]
    assert seen("nobody@x") == []
    only = security.for_region(star, "Campania", ["region", "net_sales"]).collect()
    assert [r.region for r in only] == ["Campania"]
