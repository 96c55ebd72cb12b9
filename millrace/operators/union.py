"""Union of the results of several files or groups of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import PipelineError
from millrace.functions.expr import quoted


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns. Whole numbers widen to doubles; other differences of type are an error."""
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            old = types.setdefault(f.name, f.dataType)
            if old != f.dataType:
                if {type(old), type(f.dataType)} != {T.LongType, T.DoubleType}:
                    raise PipelineError(f"column `{f.name}` is {old.simpleString()} in some files and {f.dataType.simpleString()} in others")
                types[f.name] = T.DoubleType()
    out = None
    for df in frames:
        same = df.select(*(F.col(quoted(n)).cast(t).alias(n) for n, t in types.items()))
        out = same if out is None else out.unionByName(same)
    assert out is not None
    return out
