"""Quality by regularised quadratic discriminant analysis.

Every text gives transformed statistics: logarithms of sizes and square roots of rates, the rates with pseudo-counts so that short
texts lie near the mean instead of far out. Each class has the mean and a covariance shrunk towards the pooled diagonal. A
text's score is the logistic of the difference of the two log densities, each from a Mahalanobis distance: the length of the difference
to the mean, multiplied by the inverse of the class's Cholesky factor. Factors and inverses are computed once, when the model is fitted.

The fit needs only counts, sums and cross products of the labelled rows: each task adds up its own and the driver adds
one small row a task and class. All labelled rows take part.

Null and empty texts have the statistics of no text and get a score like any other; a very long text takes time in proportion. Rows
with a null doc_id are scored, are not held out and teach nothing. With labels of one class only, or none, the score is that class's
share (no labels: 1). Repeated rows each come out and each teach; a score of exactly ``ACCEPT`` is accepted. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._arrow import named, steps, texts
from millrace.llm._labels import known, remainder
from millrace.llm._ship import ship
from millrace.llm._store import stored

#: Documents whose crc32 has this remainder are held out of the fit.
MODULUS, HELD_OUT = 3, 1
#: Share of the pooled variances in each class's covariance, and what is added to its diagonal.
SHRINK, RIDGE = 0.1, 1e-3
#: A document is kept if its score is at least this.
ACCEPT = 0.5

_CLASS = np.zeros(256, np.int64)  # 0: other, 1: capital, 2: small or beyond ASCII, 3: digit, 4: symbol, 5: pipe, 6: bang, 7: stop, 8: line end
_CLASS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_CLASS[[*b"abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = 2
_CLASS[[*b"0123456789"]] = 3
_CLASS[[*b"#$%&*@^~_=<>{}[]\\/"]] = 4
_CLASS[[*b"|"]] = 5
_CLASS[[*b"!"]] = 6
_CLASS[[*b".,;:?"]] = 7
_CLASS[[*b"\n"]] = 8

SIZE = 10


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text."""
    data = text.encode()
    n = np.bincount(_CLASS, np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=9)
    words = data.split()
    count, distinct = len(words), len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:]))
    letters, chars = n[1] + n[2], len(data)
    rate = lambda k, of, prior, weight: math.sqrt((k + prior * weight) / (of + weight))
    return [
        math.log1p(count),
        math.log((chars + 60) / (count + 10)),
        rate(n[1], letters, 0.03, 40),
        rate(n[4], chars, 0.002, 60),
        rate(n[5], count, 0.002, 10),
        rate(n[6], count, 0.002, 10),
        rate(same, count, 0.01, 10),
        rate(n[3], chars, 0.005, 60),
        rate(n[7], count, 0.15, 10),
        math.log((distinct + 10) / (count + 10)) / math.log(count + 20),
    ]


@dataclass
class Model:
    """Class means, the covariances' Cholesky factors and the inverses of these, log determinants and the log odds of the classes; no means: a constant."""

    constant: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    inverses: np.ndarray | None = None
    logdets: np.ndarray | None = None
    odds: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.constant)
        density = [-0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - d for m, f, d in zip(self.means, self.inverses, self.logdets, strict=True)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.odds, -500, 500)))


def model(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    """From each class's count, sums and cross products."""
    n = {y: moments[y][0] if y in moments else 0.0 for y in (0, 1)}
    if min(n.values()) < 2:
        return Model((n[1] + (not sum(n.values()))) / max(1, sum(n.values())))
    means = np.array([moments[y][1] / n[y] for y in (0, 1)])
    covariances = [moments[y][2] / n[y] - np.outer(means[y], means[y]) for y in (0, 1)]
    pooled = sum(n[y] * covariances[y] for y in (0, 1)) / sum(n.values())
    floor = np.diag(np.clip(np.diag(pooled), 0, None)) + RIDGE * np.eye(len(pooled))
    # Small classes lean on the pooled variances more.
    shares = [max(SHRINK, len(pooled) / (len(pooled) + n[y])) for y in (0, 1)]
    factors = np.array([np.linalg.cholesky((1 - s) * c + s * floor + RIDGE * np.eye(len(pooled))) for s, c in zip(shares, covariances, strict=True)])
    logdets = np.array([np.log(np.diag(f)).sum() for f in factors])
    return Model(0.5, means, factors, np.linalg.inv(factors), logdets, math.log(n[1] / n[0]))


def featured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x): the statistics of every whole text."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            rows = [statistics(x) for x in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["key", "x"])

    return named(docs, key=key, text=text).mapInArrow(pass_, schema)


def fit(features: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """The model of the rows of ``features`` whose key has a label and is not held out."""
    rows = features.join(known(labels, label, MODULUS, HELD_OUT), "key").select("y", "x")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            ys = np.asarray(batch.column(0))
            xs = np.asarray(batch.column(1).flatten()).reshape(len(ys), -1)
            for y in np.unique(ys).tolist():
                x = xs[ys == y]
                old = total.get(y, (0.0, 0.0, 0.0))
                total[y] = (old[0] + len(x), old[1] + x.sum(axis=0), old[2] + x.T @ x)
        if total:
            rows = [np.concatenate([[n], s, c.ravel()]).tolist() for n, s, c in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["y", "sums"])

    sums = {}
    for y, values in rows.mapInArrow(add, "y int, sums array<double>").toLocalIterator():
        sums[y] = sums.get(y, 0) + np.array(values)
    d = SIZE
    return model({y: (v[0], v[1 : d + 1], v[d + 1 :].reshape(d, d)) for y, v in sums.items()})


def score(features: DataFrame, fitted: Model) -> DataFrame:
    """(key, score) for every row of ``features``."""

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fitted.score(x))], names=["key", "score"])

    return features.mapInArrow(pass_, T.StructType([features.schema["key"], T.StructField("score", T.DoubleType())]))


def keep(docs: DataFrame, fitted: Model, text: str = "text", least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, all columns unchanged."""
    ship(docs.sparkSession)

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            x = np.array([statistics(x) for x in texts(batch, text)])
            yield batch.filter(pa.array(fitted.score(x) >= least))

    return docs.mapInArrow(pass_, docs.schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of query op2."""
    features = stored(featured(docs), "statistics")
    held = F.coalesce(remainder(F.col("key"), MODULUS) == HELD_OUT, F.lit(False))
    return score(features, fit(features, labels)).select(F.col("key").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
