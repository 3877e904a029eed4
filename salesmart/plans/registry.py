"""Every query by name, as a function of a star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from salesmart.functions.calendar import Period
from salesmart.functions.rounding import money_sum
from salesmart.operators import anomalies, forecast, quality, scenario, security, series
from salesmart.plans import analytics, kpis, reports
from salesmart.sources import extracts


def _regions_seen(lines):
    return lines.groupBy("region").agg(
        money_sum(F.col("net_sales")).alias("net_sales"),
        F.count("*").cast("bigint").alias("sales_line_count"),
    )


# Fixed slicer and role values that occur in the given tables.
SLICER_YEAR = 1997
SLICERS = {"region": "ASIA", "category": ["PROMO", "SMALL"]}
ROLE_REGION = "ASIA"
ROLE_USER = "nation_7@example.com"
PERIOD = Period(date(1998, 3, 10), date(1998, 3, 24))
SPIKE_PERIOD = Period(date(1997, 11, 15), date(1997, 12, 15))
DIP_PERIOD = Period(date(1998, 9, 1), date(1998, 9, 10))
CLOSED_STORE = 3
AS_OF = date(1998, 6, 30)
REQUIRED = ["date", "product_key", "store_key", "customer_key", "quantity"]


def _totals(star, by):
    return kpis.kpi(star, [by], ["total_net_sales", "total_quantity", "sales_line_count"])


def _text_lines(star):
    """The fact's amounts as the text an export holds."""
    types = {"date": "date", "product_key": "bigint", "quantity": "int", "net_sales": "double"}
    lines = star.sales(*types)
    return lines.select(*[F.col(c).cast("string").alias(c) for c in types]), types


def _defective_lines(star):
    """The same text with what hand-kept extracts hold: words for numbers, other date formats, blanks."""
    lines, types = _text_lines(star)
    quantity, day = F.col("quantity"), F.col("date")
    return lines.select(
        F.when(F.substring(day, 9, 2) == "31", F.concat(F.lit("31/"), F.substring(day, 6, 2))).otherwise(day).alias("date"),
        F.when(F.substring(F.col("product_key"), -1, 1) == "7", F.concat(F.lit("P"), "product_key"))
        .otherwise(F.col("product_key")).alias("product_key"),
        F.when(quantity == "13", "a dozen").when(quantity == "-13", None).otherwise(quantity).alias("quantity"),
        F.when(quantity == "50", F.concat("net_sales", F.lit(" EUR"))).otherwise(F.col("net_sales")).alias("net_sales"),
    ), types


QUERIES = {
    # star tables
    "dim_date": lambda star: star.dim_date,
    "dim_product": lambda star: star.dim_product,
    "dim_store": lambda star: star.dim_store,
    "dim_customer": lambda star: star.dim_customer,
    "fact_sales": lambda star: star.fact_sales(),
    # analytical queries
    "monthly_yoy": analytics.monthly_yoy,
    "top_products_margin": analytics.top_products_margin,
    "store_rank": analytics.store_rank,
    "category_share": analytics.category_share,
    "region_sales": lambda star: analytics.share_by(star, "region"),
    "sales_ma7": analytics.sales_ma7,
    "rfm_segments": analytics.rfm_segments,
    "rfm_scores": analytics.rfm_scores,
    "rfm_matrix": analytics.rfm_matrix,
    "rfm_scores_as_of": lambda star: analytics.rfm_scores(star.with_settings(as_of=AS_OF)),
    # measures and time intelligence
    "kpi_base": kpis.kpi_base,
    "kpi_sliced": lambda star: kpis.kpi_sliced(star, SLICER_YEAR, SLICERS),
    "kpi_matrix": lambda star: kpis.kpi_rollup(
        star, ["region", "category", "year"], ["total_net_sales", "gross_margin_pct", "customer_count", "sales_per_customer"]
    ),
    "sales_to_date": kpis.sales_to_date,
    "kpi_yoy": kpis.kpi_yoy,
    "kpi_yoy_daily": kpis.kpi_yoy_daily,
    "kpi_mom": kpis.kpi_mom,
    "rolling_months": kpis.rolling_months,
    "new_returning": kpis.new_returning,
    "kpi_labels": kpis.kpi_labels,
    # report pages
    "exec_cards": reports.exec_cards,
    "exec_trend": reports.exec_trend,
    "product_matrix": reports.product_matrix,
    "product_scatter": reports.product_scatter,
    "store_yoy": reports.store_yoy,
    "customer_cards": reports.customer_cards,
    "loyalty_age_sales": reports.loyalty_age_sales,
    # row-level security
    "rls_static": lambda star: _regions_seen(
        security.for_region(star, ROLE_REGION, ["region", "net_sales"])
    ),
    "rls_dynamic": lambda star: _regions_seen(
        security.for_user(star, ROLE_USER, star.extracts.user_region(), ["region", "net_sales"])
    ),
    "rls_kpi": lambda star: kpis.kpi(security.as_region(star, ROLE_REGION), ["category"]),
    "rls_user_kpi": lambda star: kpis.kpi(
        security.as_user(star, ROLE_USER, star.extracts.user_region()), ["region", "year"]
    ),
    "rls_anomalies": lambda star: anomalies.anomalies(security.as_region(star, ROLE_REGION)),
    # report pages under slicers
    "exec_trend_sliced": lambda star: reports.exec_trend(security.sliced(star, SLICERS)),
    "product_matrix_sliced": lambda star: reports.product_matrix(security.sliced(star, SLICERS)),
    "category_share_sliced": lambda star: analytics.category_share(
        security.sliced(star, {"year": SLICER_YEAR, "region": SLICERS["region"]})
    ),
    "store_yoy_sliced": lambda star: reports.store_yoy(security.sliced(star, SLICERS)),
    # daily series
    "daily_sales": series.daily_sales,
    "store_daily": series.store_daily,
    "daily_dense": lambda star: series.dense_daily(series.daily_sales(star), [], star.span()),
    "store_daily_dense": lambda star: series.dense_daily(
        series.daily_by(star, ["store_key"]), ["store_key"], star.span()
    ),
    # anomalies
    "anomalies": anomalies.anomalies,
    "region_anomalies": lambda star: anomalies.entity_anomalies(star, "region"),
    "region_anomalies_trailing": lambda star: anomalies.entity_anomalies(star.with_settings(trailing=True), "region"),
    "anomaly_monitor": lambda star: anomalies.monitor(star, anomalies.anomalies(star, hits_only=True)),
    "anomaly_line": lambda star: anomalies.expected_line(
        anomalies.anomalies(star), "region", ROLE_REGION
    ),
    "anomaly_counts": lambda star: anomalies.counts(anomalies.anomalies(star), "region"),
    "top_anomaly_stores": lambda star: anomalies.top_entities(
        anomalies.anomalies(star, hits_only=True), "store_name"
    ),
    "anomaly_summary": lambda star: anomalies.summary(anomalies.anomalies(star)),
    # forecast
    "forecast_daily": forecast.forecast_daily,
    "forecast_by_category": lambda star: forecast.forecast_daily(star, ("category",)),
    "forecast_backtest": forecast.forecast_backtest,
    "forecast_summary": forecast.forecast_summary,
    "forecast_totals": lambda star: reports.forecast_totals(forecast.forecast_daily(star)),
    "actual_vs_forecast": lambda star: reports.actual_vs_forecast(
        star, forecast.forecast_daily(star)
    ),
    "dq_forecast": lambda star: quality.forecast_checks(
        forecast.forecast_daily(star), star.settings.horizon_days
    ),
    # scenarios
    "scenario_closure": lambda star: _totals(
        scenario.closure(star, "store_key", CLOSED_STORE, PERIOD), "store_key"
    ),
    "scenario_spike": lambda star: _totals(scenario.spike(star, SPIKE_PERIOD, 5), "product_key"),
    "scenario_dip": lambda star: _totals(
        scenario.dip(star, ROLE_REGION, DIP_PERIOD, 0.7, 42), "date"
    ),
    "promo_tag": scenario.promo_sales,
    "detector_recall": lambda star: scenario.detector_recall(star, "region", ROLE_REGION, PERIOD),
    "detector_recall_surge": lambda star: scenario.detector_recall(
        star, "region", ROLE_REGION, PERIOD, factor=20
    ),
    "detector_recall_trailing": lambda star: scenario.detector_recall(
        star.with_settings(trailing=True), "region", ROLE_REGION, PERIOD, factor=20
    ),
    # data quality
    "load_audit": quality.load_audit,
    "raw_profile": lambda star: extracts.profile(
        star.extracts.lines(set(REQUIRED)), REQUIRED, 1000
    ),
    "raw_profile_header": lambda star: extracts.profile(
        star.extracts.lines(set(REQUIRED)), [*REQUIRED, "promo_code"], 1_000_000, star.extracts.lines(set(REQUIRED)).columns
    ),
    "lookup_audit": quality.lookup_audit,
    "dq_orphans": quality.orphans,
    "dq_returns_sign": quality.returns_sign,
    "dq_calendar_cover": quality.calendar_cover,
    "dq_constraints": quality.constraints,
    "dq_anomalies": lambda star: quality.anomaly_checks(anomalies.anomalies(star)),
    "mart_type_check": lambda star: quality.type_check(*_text_lines(star)),
    "mart_type_check_defects": lambda star: quality.type_check(*_defective_lines(star)),
    "mart_rejects": lambda star: quality.typed_or_rejected(*_defective_lines(star))[1].groupBy("quantity").agg(
        F.count("*").cast("bigint").alias("rejected_rows")
    ),
}
