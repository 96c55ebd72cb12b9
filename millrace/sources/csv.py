"""CSV files of one source container: checked and typed file by file, read in as few scans as there are kinds of files.

Only headers are read on the driver. Files with one header are scanned together as text columns; one aggregation by file
finds files with rows that are too long and which type each column has in each file (whole numbers, numbers, booleans, else
text; all of a file's rows count). Files with one header and the same types then form one typed frame.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import FileFailed, MissingColumns, PipelineError, UnknownSourceContainer
from millrace.plans.model import ColumnSchema, SourceContainer
from millrace.sources.objects import Objects

INT = r"^[+-]?[0-9]+$"
FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BOOL = r"^(true|false)$"
#: Declared types, for ``declared`` typing.
DECLARED = {"string": "string", "number": "double", "int64": "bigint", "float64": "double", "date": "date", "bool": "boolean"}
#: The text of a record that has not as many fields as the header.
_RECORD = "record__"
#: Stands for the type of a column without values.
EMPTY = "void"
#: Bytes read for a header at first.
HEADER = 1 << 16


def missing_columns(headers: Sequence[str], schema: Sequence[ColumnSchema]) -> list[str]:
    """Declared names that the headers lack, in declared order; upper and lower case differ."""
    have = set(headers)
    return [c.name for c in schema if c.name not in have]


def resolve_container(key: str, containers: Sequence[SourceContainer]) -> SourceContainer:
    """The first container whose prefix the key starts with."""
    for c in containers:
        if key.startswith(c.path_prefix):
            return c
    raise UnknownSourceContainer(key)


def header(objects: Objects, key: str) -> list[str]:
    """The names in a file's first record; none for an empty file."""
    size = HEADER
    while True:
        data = objects.read(key, size)
        text = data.decode("utf-8-sig", errors="replace")
        row = next(csv.reader(io.StringIO(text, newline="")), [])
        whole = len(data) < size
        if whole or len(list(_lines(text))) > 1:
            return row
        size *= 16


def _lines(text: str) -> Iterator[list[str]]:
    for i, row in enumerate(csv.reader(io.StringIO(text, newline=""))):
        yield row
        if i:
            return


@dataclass
class Typed:
    """Files that share header and types: their keys and their declared columns as a frame."""

    keys: list[str]
    frame: DataFrame


@dataclass
class Ingested:
    groups: list[Typed] = field(default_factory=list)
    failed: dict[str, PipelineError] = field(default_factory=dict)


def _scan(spark: SparkSession, objects: Objects, keys: list[str], width: int, multi_line: bool) -> DataFrame:
    """Text columns c0, c1, ... and the text of records of another width, with the file's path. Names are by place: headers may differ in case only."""
    schema = T.StructType([*(T.StructField(f"c{i}", T.StringType()) for i in range(width)), T.StructField(_RECORD, T.StringType())])
    reader = spark.read.schema(schema).options(header=True, multiLine=multi_line, escape='"', enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD)
    return reader.csv([objects.uri(k) for k in keys]).withColumn("file__", F.col("_metadata.file_path"))


def fields(record: Column) -> Column:
    """How many fields a record has: its commas outside quoted fields, and one."""
    plain = F.regexp_replace(record, r'(^|,)\s*"[^"]*+"(?:"[^"]*+")*+', "$1")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def _kinds(width: int) -> list[Column]:
    out = [F.count_if(fields(F.col(_RECORD)) > width).alias("over")]
    for i in range(width):
        c = F.col(f"c{i}")
        whole = c.rlike(INT) & c.try_cast("bigint").isNotNull()  # longer digits are numbers, but not whole ones
        fits = [F.count_if(x) == F.count(c) for x in (whole, c.rlike(FLOAT), c.rlike(BOOL))]
        kind = F.when(F.count(c) == 0, EMPTY).when(fits[0], "bigint").when(fits[1], "double").when(fits[2], "boolean").otherwise("string")
        out.append(kind.alias(f"k{i}"))
    return out


def ingest(objects: Objects, keys: Sequence[str], schema: Sequence[ColumnSchema], typing: str = "inferred", multi_line: bool = True) -> Ingested:
    """Read files into typed frames of the declared columns, in declared order; files that fail are left out and named.

    ``typing`` is ``inferred`` (from each file's values) or ``declared`` (values that do not fit become null). Without
    ``multi_line`` a record ends with its line, and large files are read by several tasks.
    """
    spark = objects.spark
    out = Ingested()
    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for key, names in zip(keys, pool.map(lambda k: _try_header(objects, k), keys), strict=True):
            if isinstance(names, PipelineError):
                out.failed[key] = names
            elif not names:
                out.failed[key] = FileFailed(key, "no data")
            elif lacking := missing_columns(names, schema):
                out.failed[key] = MissingColumns(key, lacking)
            else:
                by_header.setdefault(tuple(names), []).append(key)
    scanned: dict[tuple[str, ...], dict[str, tuple[str, ...]]] = {}
    for names, group in by_header.items():
        rows = _scan(spark, objects, group, len(names), multi_line)
        place = {objects.uri(k): k for k in group}
        kinds = {place[_key(r["file__"], place)]: r for r in rows.groupBy("file__").agg(*_kinds(len(names))).toLocalIterator()}
        at = [names.index(c.name) for c in schema]
        scanned[names] = {}
        for key in group:
            found = kinds.get(key)
            if found and found["over"]:
                out.failed[key] = FileFailed(key, "a row has more fields than the header")
            elif typing == "declared":
                scanned[names][key] = tuple(DECLARED.get(c.type, "string") for c in schema)
            else:
                scanned[names][key] = tuple(found[f"k{i}"] if found else EMPTY for i in at)
    # A column without a value in a file has the type that it has in the others.
    seen = [{t[i] for files in scanned.values() for t in files.values()} - {EMPTY} for i in range(len(schema))]
    usual = ["double" if s == {"bigint", "double"} else next(iter(s)) if len(s) == 1 else "string" for s in seen]
    for names, files in scanned.items():
        by_types: dict[tuple[str, ...], list[str]] = {}
        for key, types in files.items():
            by_types.setdefault(tuple(u if t == EMPTY else t for t, u in zip(types, usual, strict=True)), []).append(key)
        for types, same in by_types.items():
            frame = _scan(spark, objects, same, len(names), multi_line)
            columns = [F.col(f"c{names.index(c.name)}").try_cast(t).alias(c.name) for c, t in zip(schema, types, strict=True)]
            out.groups.append(Typed(same, frame.select(*columns)))
    return out


def _key(path: str, known: dict[str, str]) -> str:
    """A file's path as Spark names it, as the listing does."""
    plain = unquote(path)
    return plain if plain in known else _local(path)


def _local(path: str) -> str:
    """file:///x, as Spark names local files, as file:/x, as Hadoop does."""
    return unquote(path).replace("file:///", "file:/", 1)


def _try_header(objects: Objects, key: str) -> list[str] | PipelineError:
    try:
        return header(objects, key)
    except Exception as e:
        return FileFailed(key, str(e).splitlines()[0] if str(e) else type(e).__name__)
