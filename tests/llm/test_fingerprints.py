from __future__ import annotations

import hashlib

import numpy as np
import pytest

from millrace.llm import fingerprints as fp
from millrace.llm.queries import table


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def resemblance(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, found):
    """Every document against its neighbour in descending order of id, by brute force."""
    rows = sorted(rows, key=lambda r: -r[0])
    assert len(found) == len(rows)
    errors = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 3
        new = text[: len(text) - k] + after[:k]
        r = found[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == fp.fingerprint(text).hex()
        assert r.edited_fingerprint == fp.fingerprint(new).hex()
        assert r.near_next == fp.likeness(fp.fingerprint(text), fp.fingerprint(after))
        errors += [r.near_edited - resemblance(text, new), r.near_next - resemblance(text, after)]
    return np.array(errors)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    errors = check(rows, {r.doc_id: r for r in fp.digest(docs).collect()})
    assert abs(errors.mean()) < 0.01
    assert errors.std() < 0.05
    assert abs(errors).max() < 0.25


@pytest.mark.parametrize("n", [1, 2, 7])
def test_few_rows(spark, n):
    texts = ["one two three four five six seven", None, "", "éa 😀b ß", "x " * 40_000, "one", "one two three four five six eight"]
    rows = [(10 * i, t) for i, t in enumerate(texts[:n])]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, fingerprint string")
    check(rows, {r.doc_id: r for r in fp.digest(docs).collect()})


@pytest.mark.parametrize("kind", ["string", "double", "date"])
def test_ids_of_other_types_are_in_their_own_order(spark, kind):
    rng = np.random.default_rng(7)
    value = {"string": lambda i: f"doc/é{i}", "double": lambda i: i / 8 - 30, "date": lambda i: f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}"}[kind]
    rows = [(value(int(i)), " ".join(f"w{x}" for x in rng.integers(0, 9, 12))) for i in rng.permutation(300)]
    docs = spark.createDataFrame(rows, f"doc_id {'double' if kind == 'double' else 'string'}, text string").repartition(3)
    docs = docs.withColumn("doc_id", docs.doc_id.cast(kind))
    rows = sorted(rows, key=lambda r: r[0].encode() if kind == "string" else r[0])
    found = {str(r.doc_id): r for r in fp.digest(docs).collect()}
    assert len(found) == 300
    check([(i, t) for i, (_, t) in enumerate(rows)], {i: found[str(k)] for i, (k, _) in enumerate(rows)})


def plain_bins(text):
    """The bins' values before they are packed, bin by bin."""
    words = text.encode().split()
    grams = {" ".join(w.decode().lower() for w in words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    hashes = [int(fp.shingle_hashes(g)[0]) for g in grams]
    value = [min((h for h in hashes if h >> 56 == b), default=None) for b in range(256)]
    for b in [b for b in range(256) if value[b] is None]:
        attempt = 1
        while True:  # the same draws for all texts, until one hits a bin that is filled by itself
            donor = int(fp.mix(np.array([b * (1 << 20) + attempt], np.uint64))[0]) >> 56
            if any(h >> 56 == donor for h in hashes):
                break
            attempt += 1
        value[b] = min(h for h in hashes if h >> 56 == donor)
    return value


@pytest.mark.parametrize("n", [1, 4, 5, 40, 300, 3000])
def test_densification_against_plain_python(n):
    text = " ".join(f"w{i % 700}x{i % 3}" for i in range(n))
    want = plain_bins(text)
    assert fp.bins(fp.shingle_hashes(text)).tolist() == want
    low = [int(x) & 15 for x in fp.mix(np.array(want, np.uint64) + fp.U(1))]
    assert fp.fingerprint(text) == bytes(a << 4 | b for a, b in zip(low[::2], low[1::2], strict=True))


def test_ids_that_are_missing_or_repeat(spark):
    rows = [(None, f"text number {i} is here for you") for i in range(40)] + [(7, f"seven {i} times") for i in range(60)] + [(8, "eight")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = fp.digest(docs).collect()
    assert sorted((r.doc_id or 0) for r in got) == sorted((r[0] or 0) for r in rows)
    assert sorted(r.fingerprint for r in got) == sorted(fp.fingerprint(t).hex() for _, t in rows)
    assert fp.digest(docs.limit(0)).collect() == []


def test_estimates_are_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        for _ in range(60):
            common = rng.integers(0, 2**63, int(400 * share)).astype(np.uint64)
            a, b = (np.concatenate([common, rng.integers(0, 2**63, 400 - len(common)).astype(np.uint64)]) for _ in range(2))
            a, b = fp.mix(a), fp.mix(b)
            low = [(fp.mix(fp.bins(x) + fp.U(1)) & fp.U(15)).astype(np.uint8) for x in (a, b)]
            chance = 0.5**fp.BITS
            errors.append(((low[0] == low[1]).mean() - chance) / (1 - chance) - len(common) / (800 - len(common)))
    assert abs(np.mean(errors)) < 0.01


def test_densification_fills_every_bin_from_a_filled_one():
    hashes = fp.mix(np.arange(1, 6, dtype=np.uint64))
    assert set(fp.bins(hashes).tolist()) <= set(hashes.tolist())
    assert fp.bins(hashes[:0]) is None
    assert fp.likeness(b"", b"") == 1.0
    assert fp.likeness(b"", fp.fingerprint("a")) == 0.0


def test_case_and_white_space():
    assert fp.fingerprint("The quick\tbrown fox\njumps") == fp.fingerprint(" the QUICK brown  fox jumps ")
    assert fp.fingerprint("a b") != fp.fingerprint("b a")
    assert fp.fingerprint("ab") != fp.fingerprint("a b")
