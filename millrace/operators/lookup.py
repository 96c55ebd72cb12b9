"""Hierarchical keyword lookups.

A lookup's tree is flattened to one ranked list of patterns: children before a node's own rows, these by falling priority and
then as listed. The result for an input is the output of the least rank with a pattern in the input. Null inputs give null; inputs
without a hit the catch-all of the lookup that was asked.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.model import LookupMapping

#: Patterns from which on a lookup is joined over distinct inputs instead of being one CASE expression.
JOIN_FROM = 100
#: Bytes of patterns that are broadcast at a time.
BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class Entry:
    """One pattern (small letters if case does not matter), what it gives and where it ranks."""

    rank: int
    pattern: str
    any_case: bool
    output: str


@dataclass(frozen=True)
class Lookup:
    entries: tuple[Entry, ...]
    catch_all: str | None

    def match(self, text: str | None) -> str | None:
        """The result for one input, in plain Python."""
        if text is None:
            return None
        small = text.lower()
        return next((e.output for e in self.entries if e.pattern in (small if e.any_case else text)), self.catch_all)

    @property
    def large(self) -> bool:
        return len(self.entries) >= JOIN_FROM

    def column(self, text: Column) -> Column:
        """The result as one CASE expression."""
        out = None
        for output, any_case, patterns in _groups(self.entries):
            where = F.lower(text) if any_case else text
            hit = F.lit(False)
            for p in patterns:
                hit = hit | F.contains(where, F.lit(p))
            out = F.when(hit, F.lit(output)) if out is None else out.when(hit, F.lit(output))
        rest = F.lit(self.catch_all).cast("string")
        return F.when(text.isNotNull(), rest if out is None else out.otherwise(rest))


def _groups(entries: Sequence[Entry]) -> Iterator[tuple[str, bool, list[str]]]:
    """Neighbours in rank that give the same, for one branch each."""
    now: tuple[str, bool, list[str]] | None = None
    for e in entries:
        if now and now[:2] == (e.output, e.any_case):
            now[2].append(e.pattern)
        else:
            if now:
                yield now
            now = (e.output, e.any_case, [e.pattern])
    if now:
        yield now


def compile_lookup(tree: LookupMapping) -> Lookup:
    ranked: list[tuple[str, bool, str]] = []

    def add(node: LookupMapping) -> None:
        for child in node.children:
            add(child)
        any_case = bool(node.case_insensitive)
        for row in sorted(node.rows, key=lambda r: -r.priority):
            ranked.extend((p.lower() if any_case else p, any_case, row.output) for p in row.input_patterns)

    add(tree)
    entries = tuple(Entry(i, p, c, o) for i, (p, c, o) in enumerate(ranked))
    return Lookup(entries, tree.catch_all.output if tree.catch_all else None)


def build_registry(trees: Sequence[LookupMapping], prefix: str = "") -> dict[str, Lookup]:
    """Every node by its dotted id; of equal ids the last one counts."""
    out: dict[str, Lookup] = {}
    for tree in trees:
        name = prefix + tree.id
        out[name] = compile_lookup(tree)
        out |= build_registry(tree.children, name + ".")
    return out


def _blocks(entries: Sequence[Entry], most: int) -> Iterator[list[Entry]]:
    block: list[Entry] = []
    size = 0
    for e in entries:
        size += len(e.pattern.encode()) + len(e.output.encode()) + 16
        if block and size > most:
            yield block
            block, size = [], len(e.pattern.encode()) + len(e.output.encode()) + 16
        block.append(e)
    if block:
        yield block


def join_lookup(df: DataFrame, text: Column, lookup: Lookup, out: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the column ``out``: distinct inputs meet the broadcast patterns, and results come back by an equi-join.

    An input is known by 128 bits of hash: only distinct inputs travel as text, and the rows of ``df`` without it. Patterns are broadcast
    in blocks of ``most`` bytes at the utmost. Of an input's hits only the least rank is kept; hits are grouped by the hashes that their
    inputs are dealt by, so there they are already. Both inputs of the last join are plain shuffles, whose partitions
    Spark can split where one input fills a large part of the rows.
    """
    key, low, found, rank = (f"{out}__{x}" for x in ("key", "low", "hash", "rank"))
    hashes = [f"{found}{i}" for i in range(2)]
    spark = df.sparkSession
    named = lambda seed, name: F.when(text.isNotNull(), F.xxhash64(F.lit(seed), text)).alias(name)
    df = df.withColumns({name: named(i, name) for i, name in enumerate(hashes)})
    inputs = df.select(*hashes, text.alias(key)).filter(F.col(key).isNotNull()).groupBy(*hashes).agg(F.first(key).alias(key)).withColumn(low, F.lower(key))
    hits = None
    for block in _blocks(lookup.entries, most):
        patterns = F.broadcast(spark.createDataFrame([(e.rank, e.pattern, e.any_case) for e in block], "rank long, pattern string, any_case boolean"))
        part = inputs.join(patterns, F.contains(F.when(F.col("any_case"), F.col(low)).otherwise(F.col(key)), F.col("pattern"))).select(*hashes, "rank")
        hits = part if hits is None else hits.unionAll(part)
    if hits is None:
        return df.withColumn(out, F.when(F.col(hashes[0]).isNotNull(), F.lit(lookup.catch_all))).drop(*hashes)
    best = hits.groupBy(*hashes).agg(F.min("rank").alias(rank))
    outputs = spark.createDataFrame([(e.rank, e.output) for e in lookup.entries], f"`{rank}` long, `{out}` string")
    if sum(len(e.output.encode()) + 16 for e in lookup.entries) <= most:
        outputs = F.broadcast(outputs)
    hit = best.join(outputs, rank).select(*hashes, out)
    filled = df.join(hit, hashes, "left")
    if lookup.catch_all is not None:
        filled = filled.withColumn(out, F.when(F.col(hashes[0]).isNotNull(), F.coalesce(F.col(out), F.lit(lookup.catch_all))))
    return filled.drop(*hashes)
