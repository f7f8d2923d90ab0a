"""Sluice: sensor-series cleaning, gap accounting, features and forecasts as Spark jobs."""
