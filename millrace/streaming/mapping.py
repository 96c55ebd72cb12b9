"""A mapping over a stream of CSV files: the same columns as in a batch, checked and written batch by batch."""

from __future__ import annotations

from collections.abc import Mapping as Map

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.expr import project, quoted
from millrace.operators.assertions import validate_assertions
from millrace.operators.lookup import Lookup
from millrace.plans.model import AnalyticTable, Mapping, SourceContainer
from millrace.sources.csv import DECLARED


def read_stream(spark: SparkSession, folder: str, container: SourceContainer) -> DataFrame:
    """New files of a container's folder as they come, with the declared types (a stream cannot infer them)."""
    schema = T.StructType([T.StructField(c.name, T.StringType()) for c in container.schema])
    rows = spark.readStream.schema(schema).options(header=True, enforceSchema=False, escape='"').csv(folder)
    return rows.select(*(F.col(quoted(c.name)).try_cast(DECLARED.get(c.type, "string")).alias(c.name) for c in container.schema))


def map_stream(rows: DataFrame, mapping: Mapping, lookups: Map[str, Lookup]) -> DataFrame:
    """A mapping's columns over a stream. Lookups stay expressions, whatever their size: a stream cannot be joined with its own distinct inputs."""
    return project(rows, {c.name: c.expr for c in mapping.columns}, lookups, join_large=False)


def write_stream(rows: DataFrame, table: AnalyticTable, folder: str, checkpoint: str) -> DataStreamWriter:
    """A writer that appends each batch to ``folder``; a batch that breaks an assertion stops the stream before it is written."""

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if violations := validate_assertions(batch, table):
                raise ValueError("; ".join(map(str, violations)))
            # A batch that runs again after a failure replaces what it wrote before.
            batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
