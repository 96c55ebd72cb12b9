"""Helpers for Arrow-batched passes over whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._ship import ship

#: Bytes of text that one step of a pass holds decoded at a time (one longer text is taken whole).
STEP_BYTES = 4 << 20


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, cut so that ``column`` holds about ``limit`` bytes in each piece."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), dtype=np.int64)
        if not len(sizes):
            continue
        before = np.cumsum(sizes) - sizes
        cuts = np.flatnonzero(np.diff(before // limit)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as Python strings; null reads as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def quoted(name: str) -> Column:
    """The column of that very name, dots and backticks in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: other columns, whatever they are called, stay out of the way. Workers get this package."""
    ship(df.sparkSession)
    return df.select(*[quoted(old).alias(new) for new, old in columns.items()])


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, each once. Workers get this package."""
    ship(df.sparkSession)
    return df.select(*map(quoted, dict.fromkeys(names)))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has the name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
