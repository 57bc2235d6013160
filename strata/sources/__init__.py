"""Sources: CSV / Parquet readers and the file manifest."""
