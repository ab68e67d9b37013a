"""Touchline: league analytics as Spark DataFrame jobs (bronze -> silver -> gold)."""
