"""Parquet sources and sinks, and the banking tables built from the test data."""
