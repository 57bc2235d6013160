"""Sinks: observed Parquet/CSV/JDBC writes and validated publishing."""
