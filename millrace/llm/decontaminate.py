"""Benchmark decontamination with suffix arrays over shards of the training texts.

Words are lower-cased and numbered by the benchmark's vocabulary (0: not in it). A shard is a piece of a task's rows. Its
suffix array holds the word positions, sorted by the ``SPAN`` words from each on; positions whose run of benchmark words is
shorter than the shortest window can start no match and are left out. Every benchmark suffix is then binary-searched:
its window (``SPAN`` words, or the whole item if shorter) bounds a range of the array, whose entries are the verbatim
occurrences. Neighbouring occurrences on one diagonal join to the longest matches.

The benchmark travels with the tasks. One of more than ``BLOCK_CHARS`` characters is cut into blocks of items, which are
broadcast one by one; a task then takes larger shards and holds one block at a time for each. So the texts are read in
one pass whatever the benchmark's size is, in bounded memory, and neither joined nor shuffled nor stored.

Null and empty texts have no words and are clean; a very long text takes time in proportion. Items without words match nothing. Repeated
items count once by their id, and their texts are read as one item's; items with a null id taint words but are not counted as
items and have no matches listed. Repeated rows are each judged alike, whatever their ids; ids of items are listed in order. An
empty table of documents gives an empty result, an empty benchmark taints nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._arrow import free_name, named, quoted, steps, texts
from millrace.llm._ship import ship

#: Words in a window.
SPAN = 10
#: Characters of benchmark text that a task holds at a time.
BLOCK_CHARS = 4 << 20
#: Bytes of text in a shard, and in one that is held against several blocks.
SHARD_BYTES, WIDE_SHARD_BYTES = 4 << 20, 32 << 20

#: Word characters stay, capitals become small, everything else becomes a space (bytes of UTF-8; from 0x80 on all are kept).
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split()


class Benchmark(NamedTuple):
    """One block of items: their vocabulary, and for each distinct window its key, its length and the items that have it."""

    vocabulary: dict[bytes, int]
    low: np.ndarray
    high: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]
    starts: list[list[int]]


def key_array(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort as the rows do."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def benchmark_block(rows: list[tuple[str | None, str | None]], span: int = SPAN) -> Benchmark:
    vocabulary: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], tuple[set[str], set[int]]] = {}
    for item, text in rows:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text or "")]
        size = min(span, len(ids))
        for i in range(len(ids) - size + 1 if size else 0):
            of, at = windows.setdefault(tuple(ids[i : i + size]), (set(), set()))
            at.add(i)
            if item is not None:
                of.add(item)
    lengths = np.array([len(w) for w in windows], np.int64)
    low = np.zeros((len(windows), span), np.uint32)
    for k, w in enumerate(windows):
        low[k, : len(w)] = w
    # The least key above all that start with the window: its last word's number plus one.
    high = low.copy()
    high[np.arange(len(windows)), lengths - 1] += 1
    found = list(windows.values())
    return Benchmark(vocabulary, key_array(low), key_array(high), lengths, [sorted(o) for o, _ in found], [sorted(a) for _, a in found])


def occurrences(ids: np.ndarray, bench: Benchmark, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Word positions in a shard (0 separates texts) and the numbers of the windows that occur there."""
    none = np.empty(0, np.int64)
    if not len(bench.low):
        return none, none
    # How many benchmark words stand from each position on.
    edge = np.flatnonzero(ids == 0)
    if not len(edge) or edge[-1] != len(ids) - 1:
        edge = np.append(edge, len(ids))
    run = edge[np.searchsorted(edge, np.arange(len(ids)))] - np.arange(len(ids))
    at = np.flatnonzero(run >= bench.lengths.min())
    if not len(at):
        return none, none
    wide = np.concatenate([ids, np.zeros(span, ids.dtype)])
    rows = np.lib.stride_tricks.sliding_window_view(wide, span)[at]
    rows = np.where(np.arange(span) < run[at, None], rows, 0)
    keys = key_array(rows)
    array = np.argsort(keys, kind="stable")  # the suffix array, to the depth of a window
    ordered = keys[array]
    a, b = np.searchsorted(ordered, bench.low), np.searchsorted(ordered, bench.high)
    n = b - a
    which = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return at[array[a[which] + offset]], which


def shard_words(lists: list[list[bytes]], bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, a 0 after each, and where each text starts (one more entry at the end)."""
    get = bench.vocabulary.get
    starts = np.cumsum([0, *(len(w) + 1 for w in lists)])
    ids = np.fromiter((i for w in lists for i in (*[get(x, 0) for x in w], 0)), np.uint32, int(starts[-1]))
    return ids, starts


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def longest(hits: list[tuple[int, int]], bench: Benchmark) -> list[tuple[str, int, int, int]]:
    """Longest verbatim matches (item, item's word, text's word, words) from occurrences (position, window) in one text."""
    lines: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for p, w in hits:
        size = int(bench.lengths[w])
        for item in bench.items[w]:
            for s in bench.starts[w]:
                lines.setdefault((item, p - s), []).append((p, p + size))
    return sorted((item, a - d, a, b - a) for (item, d), spans in lines.items() for a, b in merged(spans))


class Block:
    """A block of the benchmark as tasks hold it: in the task itself, or fetched from a broadcast for one shard at a time."""

    def __init__(self, bench: Benchmark | None, sent: Broadcast | None = None) -> None:
        self.bench, self.sent = bench, sent

    def get(self) -> Benchmark:
        return self.bench if self.sent is None else self.sent.value

    def drop(self) -> None:
        if self.sent is not None and getattr(self.sent, "_path", None):  # the file stays
            vars(self.sent).pop("_value", None)


def blocks(benchmark: DataFrame, item_id: str, text: str, most: int, span: int = SPAN) -> list[Block]:
    """The benchmark in blocks of about ``most`` characters, items dealt by a hash. The driver holds one block at a time."""
    rows = named(benchmark, item=item_id, text=text).select(F.col("item").cast("string").alias("item"), "text")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= most:
        return [Block(benchmark_block([(r.item, r.text) for r in rows.collect()], span))]
    n = -(-2 * size // most)
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    context = benchmark.sparkSession.sparkContext
    return [Block(None, context.broadcast(benchmark_block([(r.item, r.text) for r in rows.filter(block == k).collect()], span))) for k in range(n)]


def shards(batches: Iterator[pa.RecordBatch], text: str, several: bool) -> Iterator[pa.RecordBatch]:
    """The rows in order, in pieces of a shard's bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for piece in steps(batches, text, SHARD_BYTES):
        if not several:
            yield piece
            continue
        held.append(piece)
        size += piece.column(piece.schema.get_field_index(text)).nbytes
        if size >= WIDE_SHARD_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class Found(NamedTuple):
    """What a text has of the benchmark: ranges of words, items, and the longest matches (item, item's word, text's word, words)."""

    spans: list[tuple[int, int]]
    items: set[str]
    matches: list[tuple[str, int, int, int]]


def search(lists: list[list[bytes]], held: list[Block], span: int = SPAN, want_matches: bool = True) -> dict[int, Found]:
    """What the texts of a shard, as lists of words, have of all blocks; texts without a hit are left out."""
    out: dict[int, Found] = {}
    for block in held:
        bench = block.get()
        ids, starts = shard_words(lists, bench)
        at, which = occurrences(ids, bench, span)
        if len(at):
            row = np.searchsorted(starts, at, side="right") - 1
            order = np.argsort(row, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(row[order])) + 1):
                r = int(row[group[0]])
                begin, windows = (at[group] - starts[r]).tolist(), which[group]
                old = out.get(r, Found([], set(), []))
                spans = merged(old.spans + list(zip(begin, (at[group] - starts[r] + bench.lengths[windows]).tolist(), strict=True)))
                # An item may have texts in several blocks; matches of one diagonal that meet are joined below.
                more = longest(list(zip(begin, windows.tolist(), strict=True)), bench) if want_matches else []
                out[r] = Found(spans, old.items.union(*(bench.items[w] for w in set(windows.tolist()))), old.matches + more)
        block.drop()
    if len(held) > 1:
        out = {r: f._replace(matches=joined(f.matches)) for r, f in out.items()}
    return out


def joined(matches: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    lines: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for item, start, at, n in matches:
        lines.setdefault((item, at - start), []).append((at, at + n))
    return sorted((item, a - d, a, b - a) for (item, d), spans in lines.items() for a, b in merged(spans))


NEW = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("n_longest", T.LongType()),
    ]
)


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, most: int = BLOCK_CHARS) -> DataFrame:
    """The columns ``keep`` with n_words, hit_spans (flat word ranges: start, end, start, ...), items (sorted ids) and n_longest (words of the longest match).

    Kept columns with the new names give way.
    """
    ship(docs.sparkSession)
    keep = [c for c in keep if c not in NEW.names]
    spare = free_name(docs, "text__")
    held = blocks(benchmark, item_id, item_text, most, span)

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches, spare, len(held) > 1):
            lists = [words(x) for x in texts(batch, spare)]
            found = search(lists, held, span)
            none = Found([], set(), [])
            rows = [found.get(r, none) for r in range(len(lists))]
            arrays = [
                *batch.columns[:-1],
                pa.array(list(map(len, lists)), pa.int64()),
                pa.array([[x for s in f.spans for x in s] for f in rows], pa.list_(pa.int64())),
                pa.array([sorted(f.items) for f in rows], pa.list_(pa.string())),
                pa.array([max((m[3] for m in f.matches), default=0) for f in rows], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *NEW.names])

    source = docs.select(*map(quoted, keep), quoted(text).alias(spare))
    return source.mapInArrow(pass_, T.StructType([*(docs.schema[c] for c in keep), *NEW.fields]))


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, most: int = BLOCK_CHARS) -> DataFrame:
    """Longest verbatim matches: the key, item, item_start, doc_start and n_words, positions in words.

    A row for each text, item and diagonal that holds at least one whole window.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("item", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("item_start", "doc_start", "n_words"))])
    held = blocks(benchmark, item_id, item_text, most, span)

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches, "text", len(held) > 1):
            keys = batch.column(0).to_pylist()
            found = search([words(x) for x in texts(batch, "text")], held, span)
            rows = [(keys[r], *m) for r, f in sorted(found.items()) for m in f.matches]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.string()), *(pa.array(c, pa.int64()) for c in cols[2:])], names=schema.names)

    return named(docs, key=key, text=text).mapInArrow(pass_, schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, most: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in whose text no window of the benchmark occurs, all columns unchanged."""
    ship(docs.sparkSession)
    held = blocks(benchmark, item_id, item_text, most, span)

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches, text, len(held) > 1):
            free = np.ones(batch.num_rows, bool)
            free[list(search([words(x) for x in texts(batch, text)], held, span, want_matches=False))] = False
            yield batch.filter(pa.array(free))

    return docs.mapInArrow(pass_, docs.schema)


def digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of query op5."""
    size = F.aggregate(F.sequence(F.lit(0), F.size("hit_spans") - 1), F.lit(0).cast("long"), lambda n, i: n + F.when(i % 2 == 1, F.get("hit_spans", i)).otherwise(-F.get("hit_spans", i)))
    n_hit = F.when(F.size("hit_spans") == 0, F.lit(0).cast("long")).otherwise(size)
    return (
        find(docs, benchmark, ["doc_id"], **options)
        .withColumn("n_hit", n_hit)
        .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_longest")
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
place AS (SELECT DISTINCT item, i AS j, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, s FROM place),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT r, i, n, item FROM dw JOIN bw USING (n, s)),
word AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS t(k) GROUP BY r),
line AS (SELECT DISTINCT r, item, i - j AS d, i, n FROM dw JOIN place USING (n, s) WHERE item IS NOT NULL),
first AS (SELECT *, CAST(coalesce(i > max(i + n) OVER (PARTITION BY r, item, d ORDER BY i, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS INTEGER) AS fresh FROM line),
run AS (SELECT *, sum(fresh) OVER (PARTITION BY r, item, d ORDER BY i, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM first),
match AS (SELECT r, max(i + n) - min(i) AS words FROM run GROUP BY r, item, d, g),
long AS (SELECT r, max(words) AS n_longest FROM match GROUP BY r),
item AS (SELECT r, count(DISTINCT item) AS n_items, coalesce(array_to_string(list_sort(list(DISTINCT item)), ','), '') AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_longest, 0) AS BIGINT) AS n_longest
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r) LEFT JOIN long USING (r)
"""
