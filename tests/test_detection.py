"""Anomalies, scenarios and forecasts on hand-made series, and against pandas."""

from __future__ import annotations

import datetime
import math
import statistics

import numpy as np
import pytest
from conftest import day, sale

from salesmart.functions.calendar import Period
from salesmart.operators import anomalies, forecast, quality, scenario
from salesmart.operators.series import daily_by, dense_daily, rolling_median
from salesmart.settings import DEFAULTS, Settings

START = datetime.date(2024, 1, 1)


def span(spark, days):
    last = START + datetime.timedelta(days=days - 1)
    return spark.createDataFrame([(START, last)], "first_date date, last_date date")


def score(spark, values_by_entity):
    """Detector output per entity for full daily series; ``None`` is a day without rows."""
    rows = [
        (entity, START + datetime.timedelta(days=i), float(v))
        for entity, values in values_by_entity.items()
        for i, v in enumerate(values)
        if v is not None
    ]
    days = max(map(len, values_by_entity.values()))
    daily = spark.createDataFrame(rows, "store string, date date, net_sales double")
    dense = dense_daily(daily, ["store"], span(spark, days))
    found = anomalies.flagged(
        anomalies.robust_scores(dense, ["store"], DEFAULTS), ["store"], DEFAULTS
    )
    pdf = found.toPandas().sort_values(["store", "date"])
    return {k: g.reset_index(drop=True) for k, g in pdf.groupby("store")}


def test_short_series_has_no_early_scores(spark):
    found = score(spark, {"a": [100 + (i * 7) % 13 for i in range(30)]})["a"]
    assert found["expected"].isna().tolist() == [True] * 9 + [False] * 21
    assert found["robust_z"].isna().tolist() == [True] * 18 + [False] * 12
    assert (found["is_anomaly"][:18] == 0).all() and (found["direction"][:18] == "spike").all()


def test_zero_spread_is_never_flagged(spark):
    found = score(spark, {"a": [50] * 40 + [5000]})["a"]
    last = found.iloc[-1]
    assert math.isnan(last.robust_z) and last.is_anomaly == 0 and last.direction == "spike"


def test_closed_and_late_stores_are_filled_with_zero(spark):
    wave = [1000 + 40 * (i % 7) + 3 * (i % 5) for i in range(120)]
    closed = [None if 80 <= i < 95 else v for i, v in enumerate(wave)]
    late = [None] * 50 + wave[50:]
    found = score(spark, {"open": wave, "closed": closed, "late": late})
    assert [len(g) for g in found.values()] == [120] * 3
    assert (found["late"]["net_sales"][:50] == 0).all()
    dips = found["closed"].iloc[80:95]
    assert (dips["net_sales"] == 0).all()
    assert (dips["is_anomaly"][:5] == 1).all() and (dips["direction"][:5] == "dip").all()
    assert found["open"]["is_anomaly"].sum() == 0


def test_scores_follow_the_definition(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(500, 90, 200), 2)
    values[[60, 150]] = [3000.0, 0.0]
    found = score(spark, {"a": values.tolist()})["a"]
    middle, distance = {}, {}  # by day; a day has neither before ten values are there
    for today in range(200):
        window = values[max(0, today - 27) : today + 1]
        if len(window) >= 10:
            middle[today] = statistics.median(window)
            distance[today] = abs(values[today] - middle[today])
    for today in range(200):
        row = found.iloc[today]
        spread = [distance[d] for d in range(max(0, today - 27), today + 1) if d in distance]
        if today not in middle:
            assert math.isnan(row.expected)
        else:
            assert row.expected == pytest.approx(middle[today], abs=0.0051)
        if len(spread) < 10:
            assert math.isnan(row.robust_z) and row.is_anomaly == 0
            continue
        score_today = (values[today] - middle[today]) / (1.4826 * statistics.median(spread))
        assert row.robust_z == pytest.approx(score_today, abs=0.0051)
        assert row.is_anomaly == int(abs(score_today) >= 3.5)


def test_gaps_filled_while_scoring_equal_a_dense_series(spark):
    rng = np.random.default_rng(5)
    rows = [
        (store, START + datetime.timedelta(days=int(i)), float(v))
        for store, n in (("a", 120), ("b", 40), ("c", 1), (None, 60))
        for i, v in zip(rng.choice(150, n, replace=False), rng.normal(500, 90, n).round(2), strict=True)
    ]
    # no date, beside dates and alone; a day without a price; the first day beside a row without a date
    rows += [("a", None, 3.0), ("d", None, 4.0), ("c", START + datetime.timedelta(days=200), None), ("e", None, 1.0), ("e", START, 2.0)]
    daily = spark.createDataFrame(rows, "store string, date date, net_sales double")
    dense = dense_daily(daily, ["store"], span(spark, 150))
    for settings in (DEFAULTS, Settings(trailing=True)):
        expected = anomalies.robust_scores(dense, ["store"], settings)
        found = anomalies.robust_scores(daily, ["store"], settings, span(spark, 150))
        assert found.schema.simpleString() == expected.schema.simpleString()
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    nothing = spark.createDataFrame([(None, None)], "first_date date, last_date date")
    assert anomalies.robust_scores(daily.where("date is null"), ["store"], DEFAULTS, nothing).count() == 0


def test_filled_days_are_neither_sorted_nor_framed(build):
    star = build(daily_sales_rows(40, lambda i: 1 + i % 3, ("S1", "S2")))
    plan = anomalies.entity_anomalies(star, "store_key")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Generate" not in plan


def test_entities_scored_in_batches_equal_each_alone(spark):
    rng = np.random.default_rng(8)
    rows = [
        (part, key, START + datetime.timedelta(days=int(i)), float(v))
        for part, key, n in [(float(k), str(k % 3), 1 + k * 5) for k in range(20)]
        + [(None, "0", 30), (math.nan, None, 45), (math.nan, "0", 25), (None, None, 99)]
        for i, v in zip(rng.choice(120, n, replace=False), rng.normal(500, 900, n).round(-2), strict=True)
    ]
    entity = ["part", "key"]
    daily = spark.createDataFrame([*rows, (1.0, "1", None, 5.0)], "part double, key string, date date, net_sales double")
    text = lambda frame: sorted(map(str, frame.collect()))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    for settings in (DEFAULTS, Settings(trailing=True)):
        dense = anomalies.robust_scores(dense_daily(daily, entity, span(spark, 120)), entity, settings)
        expected, hits = text(dense), text(dense.where(f"abs(z) >= {settings.z_threshold}"))
        assert 0 < len(hits) < len(expected) == 24 * 120
        for size in ("7", old):
            spark.conf.set(name, size)
            try:
                assert text(anomalies.robust_scores(daily, entity, settings, span(spark, 120))) == expected
                assert text(anomalies.robust_scores(daily, entity, settings, span(spark, 120), True)) == hits
            finally:
                spark.conf.set(name, old)


def test_medians_of_windows_with_zeros():
    rng = np.random.default_rng(9)
    for lag in (0, 1):
        for share in (0.0, 0.3, 0.5, 0.8, 1.0):
            values = np.where(rng.random(300) < share, 0.0, rng.normal(0, 50, 300).round(1))
            values[rng.random(300) < 0.1] = np.nan
            found = rolling_median(values, 28, 10, lag)
            for today in range(300):
                window = values[max(0, today - 27 - lag) : max(0, today + 1 - lag)]
                there = window[~np.isnan(window)]
                assert math.isnan(found[today]) if len(there) < 10 else found[today] == statistics.median(there)


def test_only_flagged_days_leave_the_detector_where_no_other_is_read(build):
    star = build(daily_sales_rows(60, lambda i: 900 if i == 45 else 50 + (i * 5) % 7, ("S1", "S2")))
    every = anomalies.anomalies(star)
    some = anomalies.anomalies(star, hits_only=True)
    assert every.count() == 120
    assert sorted(map(str, some.collect())) == sorted(map(str, every.where("is_anomaly = 1").collect()))
    assert some.count() >= 2 and some.schema == every.schema
    top = anomalies.top_entities(some, "store_name").collect()
    assert top == anomalies.top_entities(every, "store_name").collect() and len(top) == 2


def test_lines_of_a_store_and_day_are_not_summed_before_their_shuffle(build):
    star = build(daily_sales_rows(3, lambda i: 1 + i, ("S1", "S2")))
    plan = lambda by: daily_by(star, by)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan(["store_key"]) and "RepartitionByExpression" not in plan(["region"])
    found = {(r.store_key, r.date.day): r.net_sales for r in daily_by(star, ["store_key"]).collect()}
    assert found == {(s, d): 10.0 * d for s in (1, 2) for d in (1, 2, 3)}


def daily_sales_rows(days, quantity, stores=("S1",)):
    rows = []
    for i in range(days):
        for store in stores:
            date = (START + datetime.timedelta(days=i)).isoformat()
            rows.append(sale(len(rows) + 1, date, store=store, quantity=quantity(i)))
    return rows


def test_closure_raises_anomalies_only_in_its_store(build):
    star = build(daily_sales_rows(100, lambda i: 50 + (i * 5) % 7, ("S1", "S2")))
    period = Period(day("2024-03-10"), day("2024-03-20"))
    shut = scenario.closure(star, "store_key", 1, period)
    assert shut.sales("date").count() == 200 - 11
    before = anomalies.entity_anomalies(star, "store_key")
    after = anomalies.entity_anomalies(shut, "store_key")
    assert before.where("is_anomaly = 1").count() == 0
    hit = after.where("is_anomaly = 1").collect()
    assert hit and {r.store_key for r in hit} == {1}
    row = scenario.detector_recall(star, "store_key", 1, period).first()
    assert row.planted_days == 11 and 0 < row.flagged_days <= 11


def test_spike_multiplies_the_most_sold_product(build):
    star = build(
        [sale(1, "2024-01-01"), sale(2, "2024-01-02"), sale(3, "2024-01-02", product="P2"),
         sale(4, "2024-02-01")]
    )
    spiked = scenario.spike(star, Period(day("2024-01-02"), day("2024-01-31")), 5)
    counts = spiked.sales("date", "product_id").groupBy("date", "product_id").count().collect()
    assert {(r.date.isoformat(), r.product_id): r["count"] for r in counts} == {
        ("2024-01-01", "P1"): 1, ("2024-01-02", "P1"): 5, ("2024-01-02", "P2"): 1,
        ("2024-02-01", "P1"): 1,
    }


def test_dip_is_repeatable_and_drops_about_the_fraction(build):
    rows = [sale(i, "2024-01-05", store="S2") for i in range(2000)]
    rows += [sale(5000 + i, "2024-01-05", store="S1") for i in range(50)]
    period = Period(day("2024-01-01"), day("2024-01-10"))
    kept = lambda sales: scenario.dip(build(sales), "Campania", period, 0.7, 42)
    ids = lambda star: sorted(r[0] for r in star.sales("transaction_id").collect())
    first = ids(kept(rows))
    assert first == ids(kept(rows[::-1]))
    south = sum(1 for i in first if i < 5000)
    assert 500 < south < 700 and len(first) - south == 50


WEEK = [9, 9, 10, 10, 12, 15, 12]


def fitted(build, days, quantity, settings=DEFAULTS, backtest=True):
    star = build(daily_sales_rows(days, quantity), settings=settings)
    return star, forecast.fitted_sales(star, [], backtest)


def test_weekly_wave_is_repeated(build):
    star, rows = fitted(build, 84, lambda i: WEEK[i % 7])
    pdf = rows.toPandas().sort_values("date")
    ahead = pdf[pdf.segment == "forecast"]
    assert len(ahead) == 90
    expected = [10.0 * WEEK[(84 + h) % 7] for h in range(90)]
    np.testing.assert_allclose(ahead["prediction"], expected, atol=1e-6)
    assert (ahead["band"] < 1e-6).all()
    error = forecast.backtest_error(rows, []).first()
    assert error.tested_days == 30 and error.mape_pct == 0.0


def test_band_and_horizon(build):
    star, _ = fitted(build, 70, lambda i: WEEK[i % 7] + (i * 3) % 5)
    mart = forecast.forecast_daily(star)
    check = quality.forecast_checks(mart, 90).first()
    assert (check.forecast_rows, check.is_horizon, check.outside_band) == (90, 1, 0)
    rows = mart.collect()
    assert all(r.lower_bound is None and r.upper_bound is None for r in rows if r.segment == "actual")
    assert all(r.actual is None for r in rows if r.segment == "forecast")
    widths = {round(r.upper_bound - r.lower_bound, 1) for r in rows if r.segment == "forecast"}
    assert len(widths) == 1  # the band does not widen


def test_days_without_sales_do_not_count_in_the_error(build):
    quiet = {60, 61, 75}
    star = build([s for i, s in enumerate(daily_sales_rows(84, lambda i: WEEK[i % 7])) if i not in quiet])
    error = forecast.forecast_backtest(star).first()
    assert error.tested_days == 30 - 3


@pytest.mark.parametrize("days", [1, 5, 10, 20])
def test_short_series_gives_all_horizon_rows(build, days):
    star, rows = fitted(build, days, lambda i: 1)
    found = rows.collect()
    ahead = [r for r in found if r.segment == "forecast"]
    assert len(ahead) == star.settings.horizon_days and len(found) == days + len(ahead)
    assert all(r.prediction == pytest.approx(found[0].actual) for r in ahead)
    assert sum(r.held_out is not None for r in found) == days // 2


def test_one_fit_per_series(build):
    sales = daily_sales_rows(84, lambda i: WEEK[i % 7], ("S1", "S2"))
    star = build(sales, settings=Settings(horizon_days=14))
    mart = forecast.forecast_daily(star, ("store_key",))
    counts = mart.where("segment = 'forecast'").groupBy("store_key").count().collect()
    assert {r.store_key: r["count"] for r in counts} == {1: 14, 2: 14}


def test_planted_surge_is_found(build):
    sales = daily_sales_rows(90, lambda i: 1 + (3 * i) % 4)
    period = Period(START + datetime.timedelta(60), START + datetime.timedelta(66))
    found = scenario.detector_recall(build(sales), "store_key", 1, period, factor=30).first()
    assert (found.planted_days, found.recall) == (7, 1.0)


def test_forecast_beats_repeating_the_last_week(build):
    star, rows = fitted(build, 150, lambda i: WEEK[i % 7] + (i * 7919) % 5)
    days = sorted((r for r in rows.collect() if r.segment == "actual"), key=lambda r: r.date)
    held = star.settings.backtest_days
    week = [r.actual for r in days[-held - 7 : -held]]
    miss = lambda guess: sum(abs(r.actual - g) / r.actual for r, g in zip(days[-held:], guess, strict=True))
    assert miss([r.held_out for r in days[-held:]]) <= miss([week[i % 7] for i in range(held)])
