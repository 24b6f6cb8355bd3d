"""Sinks: Parquet, CSV and JSON, published by rename."""
