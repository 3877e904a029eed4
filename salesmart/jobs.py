"""The pipeline as jobs: extracts to warehouse and marts, forecast, anomalies."""

from __future__ import annotations

from salesmart import schema
from salesmart.operators import anomalies, forecast
from salesmart.plans.star import ExtractStar, WarehouseStar
from salesmart.sources import warehouse


def run_etl(star: ExtractStar, path: str, rejects_path: str | None = None) -> WarehouseStar:
    """Write the five tables of the star."""
    return warehouse.write_star(star, f"{path}/warehouse", rejects_path)


def run_export(star: WarehouseStar, path: str) -> dict[str, int]:
    """Write the star's CSV marts; returns rows per table."""
    warehouse.export_marts(star, f"{path}/marts")
    return warehouse.table_counts({name: star.tables[name] for name in schema.STAR_TABLES})


def run_forecast(star: WarehouseStar, path: str) -> dict[str, float]:
    """Write the daily forecast mart; returns horizon, total and back-test error."""
    fitted = forecast.fitted_sales(star, [], backtest=True).persist()
    try:
        warehouse.export_csv(forecast.as_mart(fitted, []), f"{path}/marts/forecast_daily")
        return forecast.summary(fitted).first().asDict()
    finally:
        fitted.unpersist()


def run_anomaly_detection(star: WarehouseStar, path: str) -> dict[str, object]:
    """Write the anomaly mart; the summary reads the written mart, not the detector again."""
    mart = f"{path}/marts/anomalies"
    warehouse.export_csv(anomalies.anomalies(star), mart)
    found = star.spark.read.schema(schema.ANOMALIES).option("header", True).csv(mart)
    totals = anomalies.summary(found).first().asDict()
    top = anomalies.top_entities(found, "store_name").collect()  # three rows
    return {**totals, "top_anomaly_stores": {r["store_name"]: r["anomalies"] for r in top}}


def run_analytics(star: WarehouseStar, path: str) -> dict[str, object]:
    """Forecast and anomalies, which do not depend on each other."""
    ahead, found = warehouse.together(
        lambda: run_forecast(star, path), lambda: run_anomaly_detection(star, path)
    )
    return {"forecast": ahead, "anomalies": found}


def run_all(star: ExtractStar, path: str, rejects_path: str | None = None) -> dict[str, object]:
    """Extracts to warehouse, then CSV marts, forecast and anomalies side by side."""
    written = run_etl(star, path, rejects_path)
    rows, results = warehouse.together(
        lambda: run_export(written, path), lambda: run_analytics(written, path)
    )
    return {"rows": rows, **results}
