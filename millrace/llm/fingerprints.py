"""Document fingerprints by one-permutation MinHash.

Every shingle of ``SHINGLE`` words (A-Z as a-z; a shorter text is one shingle) is hashed once. The top bits of the hash name
one of ``BINS`` bins, the rest is its value there; a bin holds its least value. An empty bin takes over the value of a filled
one by optimal densification: bins drawn by a hash of the empty bin's number and the attempt, the same for all texts, until one
is filled. Of each bin ``BITS`` low-order bits of a hash of the value are packed. Two fingerprints agree by chance in 2**-BITS of their
bins; the share of equal bins, corrected for that, estimates the resemblance of the shingle sets.

Null and empty texts have the fingerprint of no shingle: it is 1 like itself, and 0 like any other (the estimate is not made
from bins then). Equal texts have equal fingerprints. A very long text takes time in proportion, and 8 bytes a word. Repeated rows each
come out, and are each other's neighbours; an empty table gives an empty result.

For the pairs of neighbours, documents are in descending order of id (null ids last), equal ids by a hash of the text. Ids may be numbers,
dates or text, each in the order of their type. The rows
are dealt to ranges of that order, each range is sorted and read as a stream, and the first row of a range is sent to the range before
it too; that is the only shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._arrow import named, picked, steps, texts
from millrace.llm._hash import U, byte_table, mix, numbers, run_hashes, word_hashes

SHINGLE, BINS, BITS = 5, 256, 4
TABLE, FACTORS = byte_table(4, fold=True), numbers(104, SHINGLE)
_WIDTH = 8  # bits that name a bin
assert BINS == 1 << _WIDTH


@functools.lru_cache(maxsize=1)
def probes() -> np.ndarray:
    """For each bin the other bins in the order in which it tries them when it is empty."""
    tries = mix(np.arange(BINS, dtype=U)[:, None] * U(1 << 20) + np.arange(1, 24 * BINS + 1, dtype=U)) >> U(64 - _WIDTH)
    rows = [list(dict.fromkeys(r.tolist())) for r in tries]
    return np.array([r + sorted(set(range(BINS)) - set(r)) for r in rows], np.int64)


def shingle_hashes(text: str) -> np.ndarray:
    words = word_hashes(text.encode(), TABLE)
    if 0 < len(words) < SHINGLE:
        return mix((words * FACTORS[: len(words)]).sum(dtype=U, keepdims=True) + U(len(words)))
    return run_hashes(words, SHINGLE, FACTORS)


def bins(hashes: np.ndarray) -> np.ndarray | None:
    """The densified minima of all bins, or none if there is no hash."""
    if not len(hashes):
        return None
    ordered = np.sort(hashes)
    first = np.searchsorted(ordered, np.arange(BINS, dtype=U) << U(64 - _WIDTH))
    value = ordered[np.minimum(first, len(ordered) - 1)]
    filled = (first < len(ordered)) & (value >> U(64 - _WIDTH) == np.arange(BINS, dtype=U))
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = probes()[empty]
        donor = order[np.arange(len(empty)), filled[order].argmax(axis=1)]
        value = value.copy()
        value[empty] = value[donor]
    return value


def fingerprint(text: str) -> bytes:
    """The packed low-order bits of all bins; no bytes for a text without words."""
    value = bins(shingle_hashes(text))
    if value is None:
        return b""
    low = (mix(value + U(1)) & U((1 << BITS) - 1)).astype(np.uint8)
    return np.packbits(low[:, None] >> np.arange(BITS - 1, -1, -1, dtype=np.uint8) & 1).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The estimated resemblance, 0 to 1: the share of equal bins, less what chance gives."""
    if not a or not b:
        return float(a == b)
    differ = np.unpackbits(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).reshape(BINS, BITS).any(axis=1)
    chance = 0.5**BITS
    return float(max(0.0, (1 - differ.mean() - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", out: str = "fingerprint") -> DataFrame:
    """The columns ``keep`` and ``out``, the fingerprint of every whole text as binary. A kept column of that name gives way."""
    keep = [c for c in keep if c != out]

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([fingerprint(x) for x in texts(batch, text)], pa.binary())], names=[*keep, out])

    return picked(docs, *keep, text).mapInArrow(pass_, T.StructType([*(docs.schema[c] for c in keep), T.StructField(out, T.BinaryType())]))


def edited(text: str, following: str) -> str:
    """``text`` with its last third of code points replaced by the first as many of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def codes(rows: DataFrame, key: str) -> Column:
    """A whole number for each key of ``rows`` that never falls as the key rises."""
    kind = rows.schema[key].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(key).cast("long")
    if isinstance(kind, T.NumericType):
        most = 2.0**62
        number = F.col(key).cast("double")
        return F.when(F.isnan(number), F.lit(1 << 63 - 1).cast("long")).otherwise(F.greatest(F.lit(-most), F.least(F.lit(most), number)).cast("long"))
    # Seven bytes from the first on in which keys differ.
    text = F.hex(F.encode(F.col(key).cast("string"), "utf-8"))
    least, greatest = rows.agg(F.min(text), F.max(text)).first()
    same = len(os.path.commonprefix([least or "", greatest or ""])) // 2 * 2
    return F.conv(F.rpad(F.substring(text, same + 1, 14), 14, "0"), 16, 10).cast("long")


def ranges(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(range, tail, key, h, text): every row in its range of the order, and each range's first row as the tail of the range before.

    The range before the first one is the last. Ranges hold about equally many rows: bounds are quantiles of the key, and the
    rows of a key that fills several ranges, or of no key, are dealt by the hash of the text.
    """
    spark = docs.sparkSession
    rows = named(docs, key=key, text=text).withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    count = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A finer error than this would make the sketches themselves large; ranges then differ in size by a little more.
    code = codes(rows, "key")
    found = rows.select(code.alias("key")).approxQuantile("key", [i / count for i in range(1, count)], max(0.1 / count, 5e-5))
    bounds = np.unique(found).astype(np.int64)
    hot = sorted({int(v) for v, w in zip(found, found[1:], strict=False) if v == w})

    @F.pandas_udf(T.LongType())
    def place(keys: pd.Series) -> pd.Series:
        """Descending: 0 for keys above all bounds; after the others for null."""
        none = keys.isna()
        at = len(bounds) - np.searchsorted(bounds, keys.fillna(0).astype("int64"), side="right")
        return pd.Series(np.where(none, len(bounds) + 1, at))

    if hot and not isinstance(docs.schema[key].dataType, T.IntegralType):  # keys with one code are in order only if they are one
        hot = [r.code for r in rows.filter(code.isin(hot)).groupBy(code.alias("code")).agg((F.min("key") == F.max("key")).alias("one")).filter("one").collect()]
    many = F.col("key").isNull() | code.isin(hot) if hot else F.col("key").isNull()
    # A range of 128: within it 0 before, 1 to 64 in, and 65 after its hot key, if it has one (the lowest of a range at most).
    part = F.when(many, F.shiftright("h", 58) + 33).otherwise(0)
    rows = rows.withColumn("range", place(code) * 128 + part)
    heads = rows.groupBy("range").agg(F.max(F.struct("key", (-F.col("h").cast("decimal(20,0)")).alias("h"))).alias("head")).orderBy("range").collect()
    if not heads:
        return rows.select("range", F.lit(0).alias("tail"), "key", "h", "text")
    before = {r["range"]: heads[i - 1]["range"] for i, r in enumerate(heads)}
    kinds = {"range_": T.LongType(), "key_": docs.schema[key].dataType, "h_": T.LongType(), "before": T.LongType()}
    first = spark.createDataFrame(
        [(r["range"], r["head"]["key"], int(-r["head"]["h"]), before[r["range"]]) for r in heads],
        T.StructType([T.StructField(c, t) for c, t in kinds.items()]),
    )
    # One row a range, so a bounded table; a row that is not a range's first finds nothing and stays single.
    marked = rows.join(F.broadcast(first), (F.col("range") == F.col("range_")) & (F.col("h") == F.col("h_")) & F.col("key").eqNullSafe(F.col("key_")), "left")
    own = F.struct(F.col("range"), F.lit(0).alias("tail"))
    copies = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("range"), F.lit(1).alias("tail"))))
    return marked.withColumn("to", F.explode(copies)).select("to.range", "to.tail", "key", "h", "text")


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op4: each document's fingerprint, its edited text's, and their likenesses."""
    text, share = (pa.string(), T.StringType()), (pa.float64(), T.DoubleType())
    kinds = {"n_chars": (pa.int64(), T.LongType()), "edited_sha256": text, "fingerprint": text, "edited_fingerprint": text, "near_edited": share, "near_next": share}
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, t) for c, (_, t) in kinds.items())])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for the next one: range, key, text, fingerprint
        ended = None  # the range whose tail has been read
        for batch in steps(batches, "text"):
            out = []
            for where, tail, key, text in zip(*(batch.column(c).to_pylist() for c in ("range", "tail", "key")), texts(batch, "text"), strict=True):
                if tail and where == ended:
                    continue  # a repeat of the first row of the next range
                mark = fingerprint(text)
                if held is not None and held[0] == where:
                    _, old, own, own_mark = held
                    changed = edited(own, text)
                    new = fingerprint(changed)
                    out.append((old, len(own), hashlib.sha256(changed.encode()).hexdigest(), own_mark.hex(), new.hex(), likeness(own_mark, new), likeness(own_mark, mark)))
                held, ended = (None, where) if tail else ((where, key, text, mark), ended)
            if out:
                types = [batch.column("key").type, *(t for t, _ in kinds.values())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ranges(docs, "doc_id", "text").repartition(n, "range").sortWithinPartitions("range", "tail", F.desc_nulls_last("key"), "h")
    return ordered.mapInArrow(pass_, schema)
