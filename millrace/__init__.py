"""Declarative CSV to analytic tables on Spark: one JSON config in, month-partitioned Parquet out."""
