"""SimHash near-duplicates by anchor-point covering.

The 64 bits are cut into blocks, and a view joins some of them: with 3 blocks and views of one, or with 6 and views of three, two
fingerprints that differ in 4 bits or fewer differ in one bit at most in some view. The anchors of a view are the words of a
covering code of radius 1: a Hamming code on its first 15 (or 31) bits, all values on the rest. A value has an anchor
within distance 1, so one that differs from it in one bit is within 1 + 1 of that anchor: every fingerprint is
replicated to all anchors within 2 in every view, and any linked pair meets at an anchor.

The first scheme makes about 45 replicates at 2**17 anchors a view, the second about 340 at 2**26 or more. The number of distinct
fingerprints decides: from ``MANY`` on the first one's anchors would hold so many that comparing them costs more than replicating.

Only distinct fingerprints are replicated. A task reads the fingerprints of its anchors in order, one anchor at a time,
and links them by breadth-first search, which compares each fingerprint once with those not yet reached and emits a
spanning forest: one row for each newly reached fingerprint, not all pairs. Components of these links are found by
alternating large-star and small-star steps on stored tables until nothing changes.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows each come out. A null doc_id never
names a component unless the component has no other id; then component_id is null. A bit set in just half of the hashes is 0. A very
long text takes time in proportion; its shingles are hashed a block at a time. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._arrow import free_name, named, quoted, steps, texts
from millrace.llm._store import forget, stored

SHINGLE, SEED, BITS, DISTANCE = 4, 42, 64, 4
#: Distinct fingerprints from which on the wider scheme is used.
MANY = 1 << 26
#: Fingerprints replicated at a time, and shingles of a text hashed at a time.
CHUNK, BLOCK = 1 << 13, 1 << 15
#: Row numbers that are sent to every executor at most (some 50 bytes each), so that no text is shuffled to meet them.
SENT = 1 << 20


def fingerprint(text: str) -> int:
    """Bit i is set if it is set in over half of the XXH64 hashes of the text's shingles, repeats included."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first, last = np.concatenate([[0], ends[:-SHINGLE]]), ends[SHINGLE - 1 :] - 1
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(first), BLOCK):
        spans = zip(first[i : i + BLOCK].tolist(), last[i : i + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the fingerprint of every whole text as a signed 64-bit integer."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("fp", T.LongType())])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            fps = np.array([fingerprint(x) for x in texts(batch, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["key", "fp"])

    return named(docs, key=key, text=text).mapInArrow(pass_, schema)


class Scheme(NamedTuple):
    """Into how many blocks the bits are cut, how many of them a view joins, and how many bits its Hamming code takes."""

    blocks: int
    joined: int
    code: int


# Of 3 numbers with a sum of 4 or less the least is 1 or less, and of 6 the least three have a sum of 1 or less.
NARROW, WIDE = Scheme(3, 1, 15), Scheme(6, 3, 31)


def views(scheme: Scheme) -> list[list[tuple[int, int]]]:
    """Each view's blocks as (first bit, bits)."""
    cuts = [BITS * i // scheme.blocks for i in range(scheme.blocks + 1)]
    blocks = [(a, b - a) for a, b in itertools.pairwise(cuts)]
    return [list(v) for v in itertools.combinations(blocks, scheme.joined)]


@functools.lru_cache(maxsize=8)
def offsets(code: int, free: int, reach: int = 2) -> tuple[np.ndarray, ...]:
    """For each syndrome of the Hamming code, what to flip in a value of ``code`` + ``free`` bits to reach the anchors within ``reach``.

    The syndrome of a value is the exclusive or of the positions 1, 2, ... of its set code bits; the flips of so many bits that
    reach a codeword are those whose positions have that syndrome in turn.
    """
    flips = [sum(1 << i for i in bits) for k in range(reach + 1) for bits in itertools.combinations(range(code + free), k)]
    syndrome = [functools.reduce(int.__xor__, (i + 1 for i in range(code) if f >> i & 1), 0) for f in flips]
    return tuple(np.array([f for f, s in zip(flips, syndrome, strict=True) if s == k], np.uint64) for k in range(code + 1))


def anchors(fps: np.ndarray, scheme: Scheme = NARROW) -> tuple[np.ndarray, np.ndarray]:
    """Rows (number of the fingerprint, anchor) for unsigned fingerprints; an anchor's top bits name its view."""
    which, where = [], []
    for k, view in enumerate(views(scheme)):
        value, width = np.zeros(len(fps), np.uint64), 0
        for a, n in view:
            value |= (fps >> np.uint64(a) & np.uint64((1 << n) - 1)) << np.uint64(width)
            width += n
        syndrome = np.zeros(len(fps), np.int64)
        for i in range(scheme.code):
            syndrome ^= np.where(value >> np.uint64(i) & np.uint64(1), i + 1, 0)
        for s, flips in enumerate(offsets(scheme.code, width - scheme.code)):
            at = np.flatnonzero(syndrome == s)
            which.append(np.repeat(at, len(flips)))
            where.append((value[at, None] ^ flips).ravel() | np.uint64(k << 40))
    return np.concatenate(which), np.concatenate(where).astype(np.int64)


def forest(fps: np.ndarray, most: int = DISTANCE) -> list[tuple[int, int]]:
    """Edges (reached from, reached) that connect distinct fingerprints as all links of ``most`` bits or fewer do."""
    left = fps.copy()
    edges: list[tuple[int, int]] = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            now = queue.pop()
            near = np.bitwise_count(left ^ now) <= most
            if near.any():
                new = left[near]
                edges += [(int(now), int(x)) for x in new]
                queue += list(new)
                left = left[~near]
    return edges


def links(distinct: DataFrame, scheme: Scheme | None = None) -> DataFrame:
    """(a, b): links between the fingerprints of column fp, enough of them to connect what all links connect."""
    chosen = scheme or (NARROW if distinct.count() < MANY else WIDE)
    place = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("fp", T.LongType())])
    pair = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).astype(np.int64)
            for i in range(0, len(fps), CHUNK):
                part = fps[i : i + CHUNK]
                which, where = anchors(part.view(np.uint64), chosen)
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(part[which])], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b"]
        rest_a, rest_f = np.empty(0, np.int64), np.empty(0, np.int64)

        def out(where: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edges = [e for part in np.split(fps.view(np.uint64), np.flatnonzero(np.diff(where)) + 1) if len(part) > 1 for e in forest(part)]
            found = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=names)

        for batch in batches:
            rest_a, rest_f = (np.concatenate([r, np.asarray(c)]) for r, c in zip((rest_a, rest_f), batch.columns, strict=True))
            if len(rest_a):
                done = np.searchsorted(rest_a, rest_a[-1])  # the last anchor may go on
                if done:
                    yield out(rest_a[:done], rest_f[:done])
                rest_a, rest_f = rest_a[done:], rest_f[done:]
        if len(rest_a):
            yield out(rest_a, rest_f)

    spread = distinct.select("fp").mapInArrow(replicate, place)
    return spread.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, pair).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (a, b): alternating large-star and small-star steps.

    Every step is stored, so lineage stays short. Each round groups by node with minima computed before the shuffle; a
    hot node's neighbours are joined to one value, which Spark can split.
    """
    now = stored(edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links")
    for _ in range(rounds):
        # Large star: every larger neighbour of a node moves to the least of its neighbourhood.
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(now.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select("m", "v").filter("m <> v").distinct()
        # Small star: the smaller neighbours of a node, and it, move to the least of them.
        low = large.groupBy(F.col("v").alias("u")).agg(F.min("m").alias("m"))
        moved = large.select(F.col("v").alias("u"), F.col("m").alias("w")).join(low, "u")
        small = moved.select("m", F.explode(F.array("u", "w")).alias("v")).filter("m <> v").distinct()
        after = stored(small.select(F.col("m").alias("lo"), F.col("v").alias("hi")), "links")
        sign = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        same = sign(now) == sign(after)
        forget(now)
        now = after
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component): for every row its fingerprint and the smallest key reachable over links, itself included."""
    prints = stored(fingerprints(docs, key, text), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = components(links(distinct))
    # What is joined is stored first: Spark splits a large partition of a join between two plain inputs.
    reached = stored(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "reached")
    ids = stored(reached.groupBy("root").agg(F.min("least").alias("component")), "names")
    named_ = stored(reached.join(ids, "root").select("fp", "component"), "classes")
    for done in (distinct, reached, ids):
        forget(done)
    return prints.join(named_, "fp", "left").select("key", "fp", "component")


def sent(rows: DataFrame) -> DataFrame:
    """A stored table of row numbers, to be broadcast if it has ``SENT`` rows or fewer; larger ones are joined as Spark decides."""
    return F.broadcast(rows) if rows.count() <= SENT else rows


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", unnamed: bool = False, groups: Callable[[DataFrame, str, str], DataFrame] = near_duplicates) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all columns unchanged. ``groups`` finds them: (key, component).

    Rows are numbered and compared one by one, so rows that share a key and nothing else all stay. Of a group the row with
    the smallest key stays, rows without a key last; of equal keys one row. Rows without a key are compared only if
    ``unnamed``; else they all stay.
    """
    row = free_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    compared = rows if unnamed else rows.filter(quoted(key).isNotNull())
    found = stored(groups(compared, row, text).select(F.col("key").alias("row"), "component"), "groups")
    places = compared.select(quoted(row).alias("row"), F.struct(quoted(key).isNull().alias("none"), quoted(key).alias("key"), F.xxhash64(quoted(text)).alias("hash"), quoted(row).alias("row")).alias("place"))
    first = stored(found.join(places, "row").groupBy("component").agg(F.min("place")["row"].alias("row")), "first")
    gone = stored(found.join(first, "row", "left_anti").select(F.col("row").alias(row)), "gone")
    for done in (found, first):
        forget(done)
    return rows.join(sent(gone), row, "left_anti").select(*map(quoted, docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op10."""
    found = near_duplicates(docs)
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
