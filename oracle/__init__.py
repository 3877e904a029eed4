"""Independent SQL for every registered query, used only to check results."""

from __future__ import annotations

# Columns of type date per query; they are compared as ISO text.
DATES = {
    "dim_store": ["open_date"],
    "dim_customer": ["signup_date"],
    "dq_calendar_cover": ["last_calendar_date", "last_sale_date"],
    **dict.fromkeys(
        [
            "dim_date", "sales_ma7", "sales_to_date", "kpi_yoy_daily", "daily_sales",
            "store_daily", "daily_dense", "store_daily_dense", "anomalies", "region_anomalies",
            "anomaly_monitor", "anomaly_line", "rls_anomalies", "forecast_daily", "forecast_by_category",
            "actual_vs_forecast", "scenario_dip",
        ],
        ["date"],
    ),
}


def all_sql() -> dict[str, str]:
    from oracle import analytics, detection, forecast, kpis

    sql = {**analytics.SQL, **kpis.SQL, **detection.SQL, **forecast.SQL}
    for name, columns in DATES.items():
        texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
        sql[name] = f"SELECT * REPLACE ({texts}) FROM ({sql[name]})"
    return sql
