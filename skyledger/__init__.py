"""Hourly-readings analytics as Spark DataFrame jobs."""
