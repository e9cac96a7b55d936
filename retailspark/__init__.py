"""Retail data quality, cleaning, loading and analytics as Spark DataFrame jobs."""
