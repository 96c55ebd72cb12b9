"""Month-partitioned Parquet objects with stable keys, so that a job can run again.

Executors write a result to a staging folder, where it can be checked at the price of reading the columns concerned; then each file is
moved to its key. The months of a result meet in one shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.errors import UnsupportedGranularity
from millrace.functions.expr import quoted
from millrace.plans.model import Mapping, PartitionBy
from millrace.sources.objects import Objects

YEAR, MONTH = "year__", "month__"
#: Where rows without a date are staged; they are checked like the others, but belong to no month.
NO_MONTH = "0"


def partition_key(table: str, mapping: str, year: int, month: int, part: int = 0) -> str:
    """Part 0 of a month has the mapping's name; further ones, if months are split, have numbers too."""
    return f"clean/{table}/year={year:04d}/month={month:02d}/{_name(mapping, part)}"


def unpartitioned_key(table: str, mapping: str, part: int = 0) -> str:
    return f"clean/{table}/{_name(mapping, part)}"


def _name(mapping: str, part: int) -> str:
    return f"{mapping}.parquet" if not part else f"{mapping}~{part:05d}.parquet"


def with_months(df: DataFrame, column: str) -> DataFrame:
    """``df`` with text columns for a date's year and month."""
    d = F.col(quoted(column))
    part = lambda x, n: F.coalesce(F.lpad(x(d).cast("string"), n, "0"), F.lit(NO_MONTH))
    return df.withColumns({YEAR: part(F.year, 4), MONTH: part(F.month, 2)})


def partition_by_month(df: DataFrame, column: str) -> DataFrame:
    """``df`` with text columns for year and month, without rows whose date is null."""
    return with_months(df.filter(F.col(quoted(column)).isNotNull()), column)


def check_granularity(by: PartitionBy | None) -> None:
    if by and by.granularity != "month":
        raise UnsupportedGranularity(by.granularity)


@dataclass
class Staged:
    """A mapping's result in the staging folder."""

    objects: Objects
    prefix: str
    folder: str
    mapping: Mapping
    schema: object

    @property
    def frame(self) -> DataFrame:
        """The whole result, rows without a date included."""
        return self.objects.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self.objects.uri(self.folder))

    def publish(self, table: str) -> list[str]:
        """Move every file to its key, over older ones; returns the keys (under the prefix) that the mapping now has.

        Without partitions there is an object, empty or not; by month there is one for each month with rows, or several if months were
        split. Objects of other mappings, and of months that no longer have rows, stay. The first move that fails ends the upload;
        earlier ones stay.
        """
        keys: list[str] = []
        parts: dict[tuple[str, ...], int] = {}
        numbered = [k for k in self.objects.keys(f"{self.prefix}clean/{table}/") if f"/{self.mapping.id}~" in k]
        for staged in self.objects.keys(self.folder + "/"):
            *folders, name = staged.removeprefix(self.folder + "/").split("/")
            place = tuple(p.split("=", 1)[1] for p in folders)
            if not name.endswith(".parquet") or NO_MONTH in place:
                continue
            part = parts.setdefault(place, 0)
            parts[place] += 1
            if place:
                year, month = map(int, place)
                key = partition_key(table, self.mapping.id, year, month, part)
            else:
                key = unpartitioned_key(table, self.mapping.id, part)
            if not part:  # an older, longer result of the month had more parts
                for old in numbered:
                    if old.startswith(self.prefix + key.removesuffix(".parquet") + "~"):
                        self.objects.delete(old)
            self.objects.publish(staged, self.prefix + key)
            keys.append(key)
        return keys

    def discard(self) -> None:
        self.objects.delete_folder(self.folder)


def stage(df: DataFrame, mapping: Mapping, objects: Objects, prefix: str, split: bool = False) -> Staged:
    """Write a mapping's result to the staging folder.

    A month is one object, sorted by date, and so one task. With ``split`` large months are written by several tasks, as several objects:
    ranges of the date and a hash of the row, so that neither a large month nor one hot day is a single task's.
    """
    check_granularity(mapping.partition_by)
    staged = Staged(objects, prefix, objects.staging(prefix), mapping, df.schema)
    uri = objects.uri(staged.folder)
    if mapping.partition_by is None:
        # The one object is one task's to write, but not to read, project and check.
        (df if split else df.repartition(1)).write.parquet(uri)
        return staged
    date = F.col(quoted(mapping.partition_by.column))
    months = with_months(df, mapping.partition_by.column)
    placed = months.repartitionByRange(date, F.xxhash64(*(F.col(quoted(c)) for c in df.columns))) if split else months.repartition(YEAR, MONTH)
    placed.sortWithinPartitions(YEAR, MONTH, date).write.partitionBy(YEAR, MONTH).parquet(uri)
    return staged
