"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon has stated seeds and terms induced from labelled texts: word beginnings of 3 to 8 letters (whole words where they
are no longer) that many toxic texts hold and few others; every term that passes is in it. Terms are induced in two folds, and a text to
learn from gets its features from the terms of the other fold, so that the trees see what new texts will show; scores use the terms of both.
Features: lexicon densities, second-person words near lexicon words, capitals, punctuation, obfuscation rates.

The model is fitted on a sample of at most ``SAMPLE`` labelled documents of each class, those with the smallest hashes of their ids;
of rows that share an id the one with the least hash of its text teaches. So the driver holds at most 2 * SAMPLE rows of features,
and terms of at most as many texts, each in ``LEAST_HITS`` toxic ones or more; trees are grown on three quarters of the rows and
calibrated on the last. Scoring takes one pass over all texts.

Null and empty texts have the features of no text and get a score like any other; a very long text takes time in proportion. Rows with a
null doc_id are scored, are not held out and teach nothing. With labels of one class only, or none, the score is that class's share
(none: 0). Ids with equal hashes are taken in order. Repeated rows each come out; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._arrow import named, steps, texts
from millrace.llm._labels import known, remainder
from millrace.llm._store import forget, stored

#: Documents whose crc32 has this remainder are held out of the fit.
MODULUS, HELD_OUT = 4, 2
#: Labelled texts of each class to fit on, at most.
SAMPLE = 20_000
#: A text counts as toxic if its score is at least this.
ACCEPT = 0.3
#: At least so many toxic texts hold an induced term, and its log odds are at least this.
LEAST_HITS, LEAST_ODDS = 4, 2.0
LENGTHS = (3, 4, 5, 6, 7, 8)

# Seeds of the lexicon, and second-person words.
SEEDS = (
    "idiot stupid moron loser trash scum pathetic worthless disgusting clown dumb fool garbage vermin filth jerk imbecile "
    "dummkopf blöd abschaum widerlich wertlos erbärmlich connard imbécile ordure minable dégoûtant estúpido basura escoria patético asqueroso inútil"
).split()
YOU = frozenset("you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split())

#: Digits and signs that stand for letters.
LEET = str.maketrans("013457@$!|", "oieastasil")
EDGE = ".,;:!?\"'()[]{}<>*_-#$%&|/\\~`«»„“”¿¡"
MIXED = re.compile(r"[^\W\d_][0-9@$!*|][^\W\d_]|[^\W\d_](?:[.*_-][^\W\d_]\b){2,}")
NEAR = 5
N_FEATURES = 14
#: Weight of a seed, and from which on a hit is a strong one.
STRONG = 3.0
CACHE = 300_000


def plain(word: str) -> str:
    """A word in small letters without marks at its edges; digits and signs between letters read as the letters they stand for."""
    word = word.strip(EDGE).lower()
    if word.isalpha() or word.isdigit() or not any(c.isalpha() for c in word):
        return word
    return word.translate(LEET).replace("*", "").replace(".", "").replace("-", "").replace("_", "")


def terms(word: str) -> list[str]:
    """The beginnings of a plain word that the lexicon may hold; ``$`` ends a whole word."""
    return [word[:n] for n in LENGTHS if len(word) > n] + ([word + "$"] if len(word) <= LENGTHS[-1] else [])


def seed_terms() -> dict[str, float]:
    return {s + "$" if len(s) <= LENGTHS[-1] else s[: LENGTHS[-1]]: STRONG for s in SEEDS}


@dataclass
class Lexicon:
    """Weights of terms, and what words weigh, remembered for as many words as ``CACHE``."""

    weights: dict[str, float]
    seen: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "seen": {}}

    def weigh(self, word: str) -> float:
        """The largest weight of the word's terms (0: none); -1 for a second-person word."""
        got = self.seen.get(word)
        if got is None:
            if len(self.seen) >= CACHE:
                self.seen.clear()
            bare = plain(word)
            got = -1.0 if bare in YOU else max((self.weights.get(t, 0.0) for t in terms(bare)), default=0.0)
            self.seen[word] = got
        return got


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text."""
    words = text.split()
    seen, weigh = lexicon.seen.get, lexicon.weigh
    weight = [w if (w := seen(x)) is not None else weigh(x) for x in words]
    hits = [i for i, w in enumerate(weight) if w > 0]
    strong = [i for i in hits if weight[i] >= STRONG]
    near = sum(any(w < 0 for w in weight[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    you = weight.count(-1.0)
    n, chars = len(words), len(text)
    capitals = sum(map(str.isupper, words))
    codes = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)
    bangs, marks = int(codes[33] + codes[63]), int(codes[[35, 36, 37, 38, 42, 64, 94, 126]].sum())
    mixed = len(MIXED.findall(text))
    return [
        len(hits),
        len(hits) / (n + 5),
        len(strong),
        len(strong) / (n + 5),
        sum(weight[i] for i in hits) / (n + 5),
        max((weight[i] for i in hits), default=0.0),
        len({words[i] for i in hits}),
        near,
        near / (len(hits) + 1),
        you / (n + 5),
        capitals / (n + 5),
        bangs / (chars + 20),
        marks / (chars + 20),
        mixed / (n + 5),
    ]


# Boosted trees on the driver, over a bounded sample.


@dataclass
class Trees:
    """Depth-wise trees: node k of a tree has children 2k + 1 and 2k + 2; scores add up to log odds."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 2.0) -> Trees:
    """Trees that fit the log odds of ``y`` by second-order boosting over histograms of the features' quantiles."""
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    start = math.log(share / (1 - share))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    cuts = [np.unique(np.concatenate([q, [0.0]])) for q in cuts]  # zero against more than zero is always a cut
    codes = np.stack([np.searchsorted(q, c, side="left") for q, c in zip(cuts, x.T, strict=True)], axis=1)
    wide = max(len(q) for q in cuts) + 1
    inner = 2**depth - 1
    margin = np.full(len(y), start)
    model = Trees(start, np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, inner + 1)))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            slot = at - first
            best = np.zeros(count)
            for f, q in enumerate(cuts):
                if not len(q):
                    continue
                index = slot * wide + codes[:, f]
                gs = np.bincount(index, g, minlength=count * wide).reshape(count, wide).cumsum(axis=1)
                hs = np.bincount(index, h, minlength=count * wide).reshape(count, wide).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, : len(q)], hs[:, : len(q)], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < 0.5) | (ht - hl < 0.5)] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(count), k]
                for s in np.flatnonzero(top > best + 1e-12):
                    best[s] = top[s]
                    model.feature[r, first + s], model.cut[r, first + s] = f, q[k[s]]
            at = 2 * at + 1 + (x[np.arange(len(y)), model.feature[r, at]] > model.cut[r, at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, minlength=inner + 1) / (np.bincount(leaf, h, minlength=inner + 1) + ridge)
        model.leaf[r] = value
        margin += value[leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (score, probability) of the non-decreasing weighted fit of ``y`` by pooling neighbours, one pseudo-row of the mean in each block."""
    order = np.argsort(score, kind="stable")
    mean = float(np.average(y, weights=weight))
    blocks: list[list[float]] = []  # weight, toxic weight, least and greatest score
    for s, v, w in zip(score[order].tolist(), y[order].tolist(), weight[order].tolist(), strict=True):
        blocks.append([w, v * w, s, s])
        while len(blocks) > 1 and (blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            n, t, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + t, blocks[-1][2], hi]
    knots = [(s, (t + mean) / (n + 1)) for n, t, lo, hi in blocks for s in dict.fromkeys((lo, hi))]
    xs, ps = np.array([k[0] for k in knots]), np.maximum.accumulate([k[1] for k in knots])
    return xs, ps


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    constant: float = 0.0

    def score(self, batch: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(batch), self.constant)
        margin = self.trees.margin(np.array([features(x, self.lexicon) for x in batch]).reshape(-1, N_FEATURES))
        calibrated = np.interp(margin, *self.knots)
        # Inside a flat block the margin still orders texts, by less than any step matters.
        return np.clip(calibrated * (1 - 1e-6) + 1e-6 / (1 + np.exp(-np.clip(margin, -500, 500))), 0, 1)


def induced(counts: dict[str, tuple[int, int]], toxic: int, other: int) -> dict[str, float]:
    """Weights of the terms that enough toxic texts hold and that have high enough log odds, besides the seeds'."""
    found = seed_terms()
    for term, (t, o) in counts.items():
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((o + 0.5) / (other + 1))
        if t >= LEAST_HITS and odds >= LEAST_ODDS:
            found[term] = min(odds, 8.0)
    return found


def sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str) -> DataFrame:
    """(key, text, y, fold) of the texts to learn from, one a document. At most 2 * SAMPLE ids are broadcast."""
    rows = known(labels, label, MODULUS, HELD_OUT).withColumn("h", F.xxhash64("key"))
    ids = rows.filter("y = 1").orderBy("h", "key").limit(SAMPLE).unionAll(rows.filter("y = 0").orderBy("h", "key").limit(SAMPLE))
    ids = ids.select("key", "y", F.pmod("h", F.lit(4)).cast("int").alias("fold"))
    text_ = F.coalesce("text", F.lit(""))
    found = named(docs, key=key, text=text).join(F.broadcast(ids), "key")
    return found.groupBy("key", "y", "fold").agg(F.min(F.struct(F.xxhash64(text_).alias("hash"), text_.alias("text"))).alias("one")).select("key", "one.text", "y", "fold")


def _term_counts(rows: DataFrame) -> dict[int, tuple[dict[str, tuple[int, int]], int, int]]:
    """For each half (fold modulo 2) how many toxic and other texts hold a term, and how many texts there are of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", 16 << 20):
            found: Counter[tuple[str, int, int]] = Counter()
            for text, y, fold in zip(texts(batch, "text"), batch.column("y").to_pylist(), batch.column("fold").to_pylist(), strict=True):
                for t in {t for w in set(text.split()) for t in terms(plain(w))}:
                    found[t, y, fold % 2] += 1
                found["", y, fold % 2] += 1
            cols = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(list(found.values()), pa.int64())], names=["term", "y", "half", "n"])

    total = lambda half, y: F.sum(F.when((F.col("half") == half) & (F.col("y") == y), F.col("n")).otherwise(0))
    sums = rows.mapInArrow(count, "term string, y int, half int, n long").groupBy("term").agg(total(0, 1).alias("t0"), total(0, 0).alias("o0"), total(1, 1).alias("t1"), total(1, 0).alias("o1"))
    sums = stored(sums.filter((F.col("t0") + F.col("t1") >= LEAST_HITS) | (F.col("term") == "")), "terms")
    all_ = sums.filter("term = ''").first()
    out: dict[int, tuple[dict[str, tuple[int, int]], int, int]] = {h: ({}, 0, 0) for h in (0, 1)}
    if all_:
        # Only terms that pass in some half, or in both, come to the driver.
        share = lambda t, o, toxic, other: (t >= LEAST_HITS) & (F.log((t + 0.5) / (toxic + 1)) - F.log((o + 0.5) / (other + 1)) >= LEAST_ODDS - 1e-9)
        t, o = F.col("t0") + F.col("t1"), F.col("o0") + F.col("o1")
        good = share(t, o, all_.t0 + all_.t1, all_.o0 + all_.o1) | share(F.col("t0"), F.col("o0"), all_.t0, all_.o0) | share(F.col("t1"), F.col("o1"), all_.t1, all_.o1)
        out = {0: ({}, all_.t0, all_.o0), 1: ({}, all_.t1, all_.o1)}
        for r in sums.filter(good & (F.col("term") != "")).toLocalIterator():
            out[0][0][r.term], out[1][0][r.term] = (r.t0, r.o0), (r.t1, r.o1)
    forget(sums)
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    rows = stored(sample(docs, labels, label, key, text), "sample")
    halves = _term_counts(rows)
    weights = {h: Lexicon(induced(*halves[1 - h])) for h in (0, 1)}  # by the half of the text they are for: the other's terms
    names = set(halves[0][0]) | set(halves[1][0])
    both = {t: tuple(a + b for a, b in zip(halves[0][0].get(t, (0, 0)), halves[1][0].get(t, (0, 0)), strict=True)) for t in names}
    lexicon = Lexicon(induced(both, halves[0][1] + halves[1][1], halves[0][2] + halves[1][2]))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            folds = batch.column("fold")
            x = [features(t, weights[f % 2]) for t, f in zip(texts(batch, "text"), folds.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), folds, pa.array(x, pa.list_(pa.float64()))], names=["y", "fold", "x"])

    # One row of features for each sampled document.
    got = rows.mapInArrow(describe, "y int, fold int, x array<double>").toPandas()
    forget(rows)
    y = got["y"].to_numpy(float) if len(got) else np.empty(0)
    if not len(y) or y.min() == y.max():
        return Model(lexicon, None, None, float(y.mean()) if len(y) else 0.0)
    # The sample may hold another share of toxic texts than the labels do; the calibration weighs that out.
    totals = {r.y: r.n for r in known(labels, label, MODULUS, HELD_OUT).groupBy("y").agg(F.count("*").alias("n")).collect()}
    weight = np.where(y == 1, max(1, totals[1] / SAMPLE), max(1, totals[0] / SAMPLE))
    x, fold = np.stack(got["x"].to_list()), got["fold"].to_numpy()
    held = fold == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.ones(len(y), bool)  # too few to set any aside
        trees = boost(x, y)
    else:
        trees = boost(x[~held], y[~held])
    return Model(lexicon, trees, isotonic(trees.margin(x[held]), y[held], weight[held]))


def score(docs: DataFrame, fitted: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fitted.score(texts(batch, "text")))], names=["key", "score"])

    return named(docs, key=key, text=text).mapInArrow(pass_, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of query op7."""
    held = F.coalesce(remainder(F.col("key"), MODULUS) == HELD_OUT, F.lit(False))
    return score(docs, fit(docs, labels)).select(F.col("key").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
