"""Spark-native sales analytics: star schema, measures, anomalies, forecasts."""
