"""Readers: CSV, JSON, literal text, Parquet, JDBC, landed responses."""
