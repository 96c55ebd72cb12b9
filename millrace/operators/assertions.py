"""Column assertions: one aggregation over a result counts all but distinct values, which are counted column by column.

Many distinct values are dealt over tasks by a hash before they are gathered, so that no task holds more of them the larger a result is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expr import quoted
from millrace.plans.model import AnalyticTable, ColumnAssertions


@dataclass(frozen=True)
class Violation:
    """``kind`` is missing_column, not_null, unique, accepted_values or range."""

    column: str
    kind: str
    message: str

    def __str__(self) -> str:
        return f"column `{self.column}` {self.kind}: {self.message}"


#: What a check needs counted, and the message that the counts give (none if all is well).
Check = tuple[str, list[Column], Callable[[list[Any]], str | None]]
#: Bytes of distinct values meant for one task, and of each beside its text.
HELD, ENTRY = 1 << 26, 128


def _bound(x: float | None) -> str:
    """A bound as reports show it: ``None`` or ``Some(1.0)``."""
    if x is None:
        return "None"
    digits = repr(float(x))
    if "e" in digits:
        whole, _, power = digits.partition("e")
        digits = f"{whole.removesuffix('.0')}e{int(power)}"
    return f"Some({digits})"


def _number(c: Column, t: T.DataType) -> Column:
    """A column as doubles: dates as days, text that is no number as null."""
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(t, T.StringType):
        return F.when(c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), c).try_cast("double")
    return c.cast("double")


def checks(c: Column, t: T.DataType, rules: ColumnAssertions, parity_unique: bool = False) -> list[Check]:
    """The checks of one column in the order in which violations are listed.

    ``parity_unique`` counts null as one more distinct value, as the first engine of this config format does, which hides a duplicate
    in a column with nulls.
    """
    out: list[Check] = []
    if rules.not_null:
        out.append(("not_null", [F.count_if(c.isNull())], lambda n: f"{n[0]} null value(s) found" if n[0] else None))
    if rules.unique:
        null = F.max(c.isNull().cast("int")) if parity_unique else F.lit(0)
        size = F.octet_length(c) if isinstance(t, T.StringType | T.BinaryType) else F.lit(0)
        needed = [F.count(c), F.coalesce(null, F.lit(0)), F.approx_count_distinct(c), F.sum(F.when(c.isNotNull(), size)), F.max(size)]
        out.append(("unique", needed, lambda n: f"{n[0] - n[1]} duplicate value(s)" if n[1] < n[0] else None))
    if rules.accepted_values:
        allowed = rules.accepted_values
        out.append(("accepted_values", [F.count_if(~c.cast("string").isin(allowed))], lambda n: f"{n[0]} value(s) not in accepted_values ({len(allowed)} allowed)" if n[0] else None))
    if rules.min is not None or rules.max is not None:
        v = _number(c, t)
        real = ~F.isnan(v)
        below = real & (v < rules.min) if rules.min is not None else F.lit(False)
        above = real & (v > rules.max) & ~below if rules.max is not None else F.lit(False)
        text = f"(min={_bound(rules.min)}, max={_bound(rules.max)})"
        out.append(("range", [F.count_if(below), F.count_if(above)], lambda n: f"{n[0]} below min, {n[1]} above max {text}" if n[0] or n[1] else None))
    return out


def _distinct(df: DataFrame, c: Column, t: T.DataType, values: int, about: int, size: int, longest: int) -> int:
    """How many distinct values a column has, null left out. ``about``, an estimate, and the bytes of texts only say over how many tasks they are dealt."""
    if not values:
        return 0
    tasks = -(-min(about * (ENTRY + longest), values * ENTRY + size) // HELD)
    if tasks <= 1:
        return df.agg(F.count_distinct(c)).first()[0]
    # Values that are to be unique gain nothing from being gathered where they are read, which holds all of a task's at once.
    rows = df.filter(c.isNotNull()).select(c.alias("value"))
    if not isinstance(t, T.FloatType | T.DoubleType):
        return rows.repartition(tasks, "value").distinct().count()
    # Spark gathers doubles by another expression (one zero, one NaN) and would deal them again; equal ones have one hash.
    return rows.withColumn("hash", F.xxhash64("value")).repartition(tasks, "hash").distinct().count()


def validate_assertions(df: DataFrame, table: AnalyticTable, parity_unique: bool = False) -> list[Violation]:
    """All violations, columns in schema order. One pass computes every count but those of distinct values, which take one more a column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    listed: list[tuple[str, Check | None]] = []
    for col in table.schema:
        if col.assertions is None:
            continue
        if col.name not in types:
            listed.append((col.name, None))
            continue
        listed += [(col.name, c) for c in checks(F.col(quoted(col.name)), types[col.name], col.assertions, parity_unique)]
    wanted = [x for _, c in listed if c for x in c[1]]
    counts = list(df.agg(*(x.alias(f"n{i}") for i, x in enumerate(wanted))).first()) if wanted else []
    out: list[Violation] = []
    for name, check in listed:
        if check is None:
            out.append(Violation(name, "missing_column", "column not present in produced DataFrame"))
            continue
        kind, needed, message = check
        got, counts = counts[: len(needed)], counts[len(needed) :]
        if kind == "unique":
            values, null, *sizes = got
            got = [values, null + _distinct(df, F.col(quoted(name)), types[name], values, *sizes)]
        if text := message(got):
            out.append(Violation(name, kind, text))
    return out
