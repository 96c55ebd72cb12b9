from __future__ import annotations

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash as sh
from millrace.llm.queries import table


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, fps):
    """Components by comparing all pairs; their names are the least keys."""
    fps = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4) + i + 1:
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, k in enumerate(keys):
        r = root(i)
        least[r] = k if least.get(r) is None else least[r] if k is None else min(k, least[r])
    return [least[root(i)] for i in range(len(fps))]


@pytest.mark.parametrize("block", [1 << 15, 7])
def test_fingerprints(block, monkeypatch):
    monkeypatch.setattr(sh, "BLOCK", block)
    for text in ("", "  ", "One", "one TWO three", "a b c d", "The quick é brown fox\n jumps over the lazy dog " * 3, "x y " * 300):
        assert sh.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("scheme", [sh.NARROW, sh.WIDE])
def test_any_linked_pair_meets_at_an_anchor(scheme):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**64, 400, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    places = [{} for _ in range(2)]
    for place, fps in zip(places, (x, y), strict=True):
        for w, a in zip(*sh.anchors(fps, scheme), strict=True):
            place.setdefault(int(w), set()).add(int(a))
    assert all(places[0][i] & places[1][i] for i in range(len(x)))


def test_the_code_covers_with_radius_one():
    flips = sh.offsets(15, 6)
    words = [v for v in range(1 << 15) if not np.bitwise_xor.reduce([0] + [i + 1 for i in range(15) if v >> i & 1])]
    assert len(words) == 2**11
    assert len({w ^ e for w in words for e in [0] + [1 << i for i in range(15)]}) == 1 << 15
    assert sum(map(len, flips)) == 1 + 21 + 210


@pytest.mark.parametrize("scheme", [sh.NARROW, sh.WIDE, None])
def test_links_connect_what_all_pairs_connect(spark, scheme):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fps = [int(b) for b in base]
    for b in base[:20]:  # chains of changed bits, and crowds
        x = int(b)
        for _ in range(rng.integers(1, 12)):
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                x ^= 1 << int(bit)
            fps.append(x)
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    got = sh.components(sh.links(spark.createDataFrame([(f,) for f in signed], "fp long"), scheme))
    roots = {r.node: r.root for r in got.collect()}
    want = plain_components(list(range(len(fps))), fps)
    mine = [roots.get(s, s) for s in signed]
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_components_of_long_paths(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000)], "a long, b long")
    assert {(r.node, r.root) for r in sh.components(edges).collect()} == {(i, 0) for i in range(1, n + 1)}
    assert sh.components(edges.limit(0)).collect() == []


TEXTS = [
    (5, "the same text stands here more than once today"),
    (3, "the same text stands here more than once today"),
    (3, "the same text stands here more than once today"),
    (None, "the same text stands here more than once today"),
    (9, None),
    (8, ""),
    (None, "alone without any id at all in the table"),
    (20, "quite another text with words of its own making"),
    (21, "long " * 40_000),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*t, "c") for t in TEXTS], "doc_id long, text string, component string").repartition(3)
    got = sorted(map(tuple, sh.digest(docs).collect()), key=repr)
    want = [(k, f"{sh.fingerprint(t or ''):016x}", c) for (k, t), c in zip(TEXTS, plain_components([k for k, _ in TEXTS], [sh.fingerprint(t or "") for _, t in TEXTS]), strict=True)]
    assert got == sorted(want, key=repr)
    assert sh.digest(docs.limit(0)).collect() == []


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(*t, 1.5) for t in TEXTS], "doc_id long, text string, extra double").repartition(3)
    got = sorted(((r.doc_id, r.extra) for r in sh.keep_one(docs).collect()), key=repr)
    assert got == sorted([(3, 1.5), (8, 1.5), (20, 1.5), (21, 1.5), (None, 1.5), (None, 1.5)], key=repr)
    assert sh.keep_one(docs).columns == docs.columns


def test_rows_that_share_an_id_are_compared_one_by_one(spark):
    a, b = "the same text stands here more than once today", "quite another text with words of its own making"
    schema = "doc_id long, text string, extra long"
    clash = spark.createDataFrame([(5, a, 0), (5, b, 1), (3, b, 2), (9, a, 3)], schema).repartition(3)
    assert sorted(r.extra for r in sh.keep_one(clash).collect()) == [0, 2]
    alone = spark.createDataFrame([(5, a, 0), (5, b, 1)], schema)
    assert sorted(r.extra for r in sh.keep_one(alone).collect()) == [0, 1]
    nulls = spark.createDataFrame([(None, a, 0), (7, a, 1), (None, b, 2), (None, b, 3), (None, "alone without any id", 4)], schema).repartition(3)
    got = sorted((r.extra, r.text) for r in sh.keep_one(nulls, unnamed=True).collect())
    assert [t for _, t in got] == [a, b, "alone without any id"] and got[0] == (1, a)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [sh.fingerprint(t) for _, t in rows]
    want = {(k, f"{f:016x}", c) for (k, _), f, c in zip(rows, fps, plain_components([k for k, _ in rows], fps), strict=True)}
    assert set(map(tuple, sh.digest(docs).collect())) == want
