"""Substring deduplication with a log-structured index of window fingerprints.

A window is ``SIZE`` consecutive words. The index does not hold every window: by winnowing, a window is represented by the least
hash among its runs of ``GRAM`` words (the leftmost on ties), which depends on the window's words alone, so windows that are
equal anywhere have the same representative, at the same place in them. The windows of a text fall into stretches with one
representative. Of each stretch the index holds the representative's fingerprint and one of the whole stretch.

The index is a list of immutable runs in a folder: fingerprints with how often they occur, counted before they are shuffled, in
buckets and sorted in each. A batch
of texts becomes a run and is merge-joined with every older one, bucket by bucket; runs are compacted to one when there are more than
``FANOUT``. An index with a folder of its own outlives the call: a later batch is held against all that came before, whose stretches and texts it keeps too.
Without one the texts go through a temporary index in ``BATCHES`` batches.
Fingerprints that occur twice or more are then verified: stretches that are repeated as a whole are repeats in all
their windows; the rest of those with a repeated representative are taken apart, and their windows are
compared one by one by 128 bits of hash over the words. Nothing is decided on the representative alone.

Null and empty texts have no words and lose nothing; a very long text takes time in proportion, and some 100 bytes a word. Repeated
rows are copies like any other: all lose what they share, and rows with one id and different texts are each judged by their own
text. Rows are told apart by 128 bits of hash over id and text; rows equal in both share their verdict. A tie between hashes within a
window goes to the leftmost. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._arrow import named, steps, texts
from millrace.llm._hash import U, byte_table, mix, numbers, rolling_hashes, run_hashes, word_hashes
from millrace.llm._ship import ship
from millrace.llm._store import forget, new_path, stored
from millrace.sources.objects import Objects

SIZE, GRAM = 35, 8
#: Texts come in so many batches; runs are compacted when there are more than FANOUT.
BATCHES, FANOUT = 4, 8
TABLES = (byte_table(8, fold=False), byte_table(80, fold=False))
FACTORS = numbers(108, GRAM)
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
ROW = ["x", "y"]
ENTRY = "fp long, whole long, x long, y long, start int, n int"
#: With it Spark reads a bucket of one sorted file as sorted.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def windows(text: str, size: int = SIZE) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words, and both 64-bit hashes of every window."""
    data = text.encode()
    words = data.split()
    if len(words) < size:
        return words, np.empty(0, U), np.empty(0, U)
    first, second = (rolling_hashes(word_hashes(data, t), size, b) for t, b in zip(TABLES, BASES, strict=True))
    return words, first, second


def stretches(text: str, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each stretch of windows with one representative: its fingerprint, one of all its words, its first window, its windows."""
    none = np.empty(0, np.int64)
    data = text.encode()
    own = word_hashes(data, TABLES[0])
    n = len(own) - size + 1
    if n < 1:
        return none, none, none, none
    grams = run_hashes(own, gram, FACTORS)
    view = np.lib.stride_tricks.sliding_window_view(grams, size - gram + 1)
    at = np.concatenate([view[i : i + 65536].argmin(axis=1) + np.arange(i, min(n, i + 65536)) for i in range(0, n, 65536)])
    start = np.flatnonzero(np.diff(at, prepend=-1))
    count = np.diff(np.append(start, n))
    # The stretch's words run from its first window's first word to its last window's last; its hash covers them and their number.
    inverse = U(pow(BASES[0], -1, 1 << 64))
    up = np.cumprod(np.concatenate([[U(1)], np.full(len(own) - 1, U(BASES[0]))]))
    down = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, inverse)]))
    sums = np.concatenate([[U(0)], np.cumsum(mix(own) * up)])
    whole = mix((sums[start + count + size - 1] - sums[start]) * down[start] + count.astype(U))
    return grams[at[start]].view(np.int64), whole.view(np.int64), start, count


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, x, y): two hashes that are equal for rows with equal id and text only; those share their verdict anyway."""
    rows = named(docs, key=key, text=text)
    of = (F.coalesce(F.col("key").cast("string"), F.lit("\x00")), F.coalesce("text", F.lit("")))
    return rows.withColumns({"x": F.xxhash64(*of), "y": F.xxhash64(F.lit("again"), *of)})


def index_entries(rows: DataFrame) -> DataFrame:
    """The stretches of all texts, each with its row and place."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            found = [stretches(x) for x in texts(batch, "text")]
            lengths = [len(f[0]) for f in found]
            fp, whole, start, n = (np.concatenate([f[i] for f in found]) for i in range(4))
            x, y = (np.repeat(np.asarray(batch.column(c)), lengths) for c in ROW)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (fp, whole, x, y, start.astype(np.int32), n.astype(np.int32))], names=["fp", "whole", *ROW, "start", "n"])

    return rows.select(*ROW, "text").mapInArrow(pass_, ENTRY)


class Index:
    """Immutable runs (fp, times) in buckets of the fingerprint, sorted in each, and what they were counted from.

    All runs of an index have the same buckets, so runs are merge-joined bucket by bucket: a new batch is shuffled once, as counts, when it
    becomes a run, and history never again. With a ``path`` (in storage that all executors share) an index is kept: its manifests
    name the runs and the stretches and texts of every batch, the one with the highest number counts, and a batch that fails half-way
    leaves the last one in force. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        ship(spark)
        self.spark = spark
        self.kept = path is not None
        self.files = Objects(spark, path or new_path(spark, "index"))
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[str] = []
        self.batches: list[str] = []
        self.version = 0
        manifests = self.files.keys("manifest-") if self.kept else []
        if manifests:
            doc = json.loads(self.files.read(manifests[-1]))
            self.buckets, self.runs, self.batches, self.version = doc["buckets"], doc["runs"], doc["batches"], doc["version"]
            for name in self.runs:
                self._declare(name)

    def _declare(self, name: str) -> None:
        """Make the session's catalog know a run."""
        if not self.spark.catalog.tableExists(name):
            place = self.files.uri(name).replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {name} (fp long, times long) USING parquet CLUSTERED BY (fp) SORTED BY (fp) INTO {self.buckets} BUCKETS LOCATION '{place}'")

    def _write(self, counts: DataFrame) -> str:
        name = "run_" + uuid.uuid4().hex
        counts.select("fp", "times").write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", self.files.uri(name)).saveAsTable(name, format="parquet")
        return name

    def run(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def met(self, new: str, old: str) -> DataFrame:
        """The fingerprints of one run that another has too."""
        return self.run(new).select("fp").hint("merge").join(self.run(old).select("fp").hint("merge"), "fp", "left_semi")

    def add(self, entries: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """(fp): the fingerprints of a batch of stretches that are now known to occur twice or more. The batch becomes a run.

        A kept index also keeps the stretches, and the texts (x, y, text) they are from.
        """
        batch = uuid.uuid4().hex
        if self.kept:
            entries.write.parquet(self.files.uri(f"batch_{batch}/entries"))
            rows.select(*ROW, "text").write.parquet(self.files.uri(f"batch_{batch}/texts"))
            entries = self._read([batch], "entries", ENTRY)
        name = self._write(entries.groupBy("fp").agg(F.count("*").alias("times")).repartition(self.buckets, "fp"))
        try:
            with ordered(self.spark):
                repeated = union([self.run(name).filter("times > 1").select("fp"), *(self.met(name, old) for old in self.runs)])
                repeated = stored(repeated.distinct(), "repeated")
        except Exception:
            self._drop(name)
            raise
        self.runs.append(name)
        self.batches.append(batch)
        self._commit()
        return repeated

    def _read(self, batches: list[str], what: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(self.files.uri(f"batch_{b}/{what}") for b in batches))

    def entries(self) -> DataFrame:
        """The stretches of all batches of a kept index."""
        return self._read(self.batches, "entries", ENTRY)

    def rows(self) -> DataFrame:
        """(x, y, text) of all batches of a kept index."""
        return self._read(self.batches, "texts", "x long, y long, text string")

    def _commit(self) -> None:
        if self.kept:
            self.version += 1
            doc = {"buckets": self.buckets, "runs": self.runs, "batches": self.batches, "version": self.version}
            self.files.write(f"manifest-{self.version:012d}.json", json.dumps(doc).encode())

    def compact(self) -> None:
        """One run of all, with the sums of their counts."""
        if len(self.runs) < 2:
            return
        old = list(self.runs)
        both = self.run(old[0])
        for name in old[1:]:
            more = self.run(name).withColumnRenamed("times", "more").hint("merge")
            sums = F.coalesce("times", F.lit(0)) + F.coalesce("more", F.lit(0))
            both = both.hint("merge").join(more, "fp", "full_outer").select("fp", sums.alias("times"))
        with ordered(self.spark):
            self.runs = [self._write(both)]
        self._commit()
        for name in old:
            self._drop(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.files.delete_folder(name)

    def clear(self) -> None:
        """Delete the index and all that it holds."""
        for name in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.files.delete_folder("")
        self.runs, self.batches = [], []


@contextmanager
def ordered(spark: SparkSession) -> Iterator[None]:
    """Within it sorted runs are read as such."""
    old = spark.conf.get(ORDERED)
    spark.conf.set(ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(ORDERED, old)


def union(frames: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionAll, frames)


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", index: Index | None = None) -> tuple[DataFrame, DataFrame]:
    """The numbered rows, and (x, y, spans): for rows with repeated windows the flat list start, end, ... of windows (end exclusive).

    With an ``index`` the rows are its next batch, and a window is repeated if it stands anywhere in them or in what the index holds.
    """
    rows = numbered(docs, key, text)
    entries = stored(index_entries(rows), "entries")
    if index is None:
        runs, batch = Index(docs.sparkSession), F.pmod("x", F.lit(BATCHES))
        try:
            known = union([runs.add(entries.filter(batch == b)) for b in range(BATCHES)])
        finally:
            runs.clear()
        places, source = entries, rows
    else:
        known = index.add(entries, rows)
        places, source = index.entries(), index.rows()
    # What is joined is stored first: Spark splits a large partition of a join between two plain inputs.
    known = stored(known.distinct(), "known")
    some = stored(places.join(known, "fp").select("fp", "whole", *ROW, "start", "n"), "candidates")
    forget(entries)
    if index is not None and len(index.runs) > FANOUT:
        index.compact()
    # Repeated as a whole: all windows of the stretch are repeats. (The hash covers the words and their number.)
    full = stored(some.groupBy("fp", "whole").agg(F.count("*").alias("times")).filter("times > 1").select("fp", "whole", F.lit(True).alias("sure")), "full")
    judged = stored(some.join(full, ["fp", "whole"], "left"), "judged")
    sure = judged.filter("sure").select(*ROW, "start", "n")
    open_ = judged.filter("sure is null")
    # A window of an open stretch may also stand in one that is repeated as a whole with other neighbours: of those, one each.
    samples = judged.filter("sure").groupBy("fp", "whole").agg(F.min(F.struct(*ROW, "start", "n")).alias("one")).select("fp", "one.*", F.lit(2).alias("times"))
    doubtful = stored(open_.select("fp").distinct(), "doubtful")
    compared = open_.select("fp", *ROW, "start", "n", F.lit(1).alias("times")).unionByName(samples.join(doubtful, "fp", "left_semi"))
    asked = stored(compared.groupBy(*ROW).agg(F.collect_list(F.struct("start", "n", "times")).alias("asked")), "asked")

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for text_, x, y, asked_ in zip(texts(batch, "text"), *(batch.column(c).to_pylist() for c in (*ROW, "asked")), strict=True):
                _, first, second = windows(text_)
                for s in asked_:
                    k = s["n"]
                    place = slice(s["start"], s["start"] + k)
                    found = (first[place].view(np.int64), second[place].view(np.int64), np.full(k, x), np.full(k, y), np.arange(s["start"], s["start"] + k), np.full(k, s["times"]))
                    for col, more in zip(out, found, strict=True):
                        col.append(more)
            cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["a", "b", *ROW, "at", "times"])

    # Repeated rows have sure stretches only; what they are asked for counts twice as it is, so they do no harm here.
    whole_rows = source.select(*ROW, "text").join(asked, ROW)
    single = stored(whole_rows.mapInArrow(take_apart, "a long, b long, x long, y long, at long, times long"), "windows")
    twice = stored(single.groupBy("a", "b").agg(F.sum("times").alias("all")).filter("`all` > 1").select("a", "b"), "twice")
    found = single.join(twice, ["a", "b"]).filter("times = 1").select(*ROW, F.col("at").cast("int").alias("start"), F.lit(1).alias("n"))
    flat = F.flatten(F.transform(F.sort_array(F.collect_set(F.struct("start", "n"))), lambda s: F.array(s["start"], s["start"] + s["n"])))
    spans = stored(sure.unionAll(found).groupBy(*ROW).agg(flat.alias("spans")), "spans")
    for done in (known, some, full, judged, doubtful, asked, single, twice):
        forget(done)
    return rows, spans


def mark(n_words: int, spans: list[int], size: int = SIZE) -> np.ndarray:
    """Which words a repeated window covers, from flat ranges of windows."""
    edge = np.zeros(n_words + 1, np.int64)
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        edge[a] += 1
        edge[min(n_words, b + size - 1)] -= 1
    return edge.cumsum()[:n_words] > 0


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", index: Index | None = None) -> DataFrame:
    """(key, n_words, n_removed, kept): every row's words without those that a repeated window covers, joined by spaces.

    With an ``index`` the rows are its next batch: they are also held against all that it holds, and added to it. Rows of
    earlier batches keep the verdicts that they were given.
    """
    return _removed(docs, key, text, digest_only=False, index=index)


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op8."""
    return _removed(docs, "doc_id", "text", digest_only=True).withColumnRenamed("key", "doc_id").withColumnRenamed("kept", "kept_sha256")


def _removed(docs: DataFrame, key: str, text: str, digest_only: bool, index: Index | None = None) -> DataFrame:
    rows, spans = repeats(docs, key, text, index)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            out = []
            for text_, found in zip(texts(batch, "text"), batch.column("spans").to_pylist(), strict=True):
                words = text_.encode().split()
                gone = mark(len(words), found or [])
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if found else words)
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest() if digest_only else kept.decode()))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=schema.names)

    return rows.join(spans, ROW, "left").select("key", "text", "spans").mapInArrow(pass_, schema)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM win SEMI JOIN twice USING (h), unnest(range(0, 35)) AS t(k)),
word AS (SELECT r, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
