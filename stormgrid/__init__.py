"""Forecast risk analytics on Spark: landing, cleaning, scoring, keyed load and reporting."""
