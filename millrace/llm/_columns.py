"""Column expressions that several native operators need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values that are summed up one by one.
CHUNK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def sums_before(sizes: Column) -> Column:
    """For each element of an array of whole numbers the sum of all before it.

    Sums over chunks come first, so the work grows with the number of elements times ``CHUNK`` at most.
    """
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    chunk = F.lit(CHUNK)

    def of(step: Column) -> Column:
        # The chunk after the last is empty and its sum is zero.
        parts = F.transform(F.sequence(F.lit(0), F.floor(F.size(step) / chunk).cast("int")), lambda j: total(F.slice(step, j * chunk + 1, chunk)))
        before = F.aggregate(parts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        own = lambda i: total(F.slice(step, F.floor(i / chunk).cast("int") * chunk + 1, i % chunk))
        return let(before, lambda sums: F.transform(step, lambda _, i: F.get(sums, F.floor(i / chunk).cast("int")) + own(i)))

    return let(sizes, of)
