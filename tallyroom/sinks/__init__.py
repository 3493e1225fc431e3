"""Parquet and JSON writers."""
