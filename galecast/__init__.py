"""Forecast-risk analytics on PySpark: ingest, clean, score, version and serve per-city forecasts."""
