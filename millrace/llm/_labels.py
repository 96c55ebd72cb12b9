"""Labelled rows and held-out remainders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def known(labels: DataFrame, label: str, modulus: int, held_out: int) -> DataFrame:
    """(key, y) for the ids to learn from: not held out, labelled 0 or 1, once each; ids with both labels teach nothing."""
    rows = labels.select(F.col("doc_id").alias("key"), F.col(label).cast("int").alias("y"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("key"), modulus) != held_out))
    return rows.groupBy("key").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").drop("most")
