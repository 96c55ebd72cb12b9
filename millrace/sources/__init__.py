"""CSV files in, Parquet objects out."""
