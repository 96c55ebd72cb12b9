from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from millrace.llm import substring as sub
from millrace.llm.queries import QUERIES
from tests_support import against_sql


def plain(docs, size=35):
    texts = [(t or "").encode().split() for _, t in docs]
    seen = Counter(tuple(w[i : i + size]) for w in texts for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(docs, texts, strict=True):
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def fixture(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice(["", "é", "X"])
    text = lambda n: [word() for _ in range(n)]
    shared = [text(n) for n in (34, 35, 36, 60, 200)]
    docs = []
    for i in range(80):
        parts = [text(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            a = rng.randint(0, 3)
            parts += [s[a:], text(rng.randint(0, 20))]
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(w for p in parts for w in p)))
    same = " ".join(text(70))
    near = same.split()
    near[40] = "changed"
    docs += [(200, same), (201, same), (201, same), (None, same), (202, " ".join(near)), (203, None), (204, ""), (205, "  "), (None, "x")]
    docs += [(206, "go " * 200), (207, " ".join(text(20)) + " " + " ".join(text(40) * 2)), (208, " ".join(text(50)))]
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    docs = fixture(seed)
    frame = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, text string, row int, spans string").repartition(3)
    assert sorted(map(tuple, sub.digest(frame).collect()), key=repr) == sorted(plain(docs), key=repr)


def test_kept_words(spark):
    docs = fixture(4)
    got = sub.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(((r.key, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got), key=repr) == sorted(((d, h) for d, _, _, h in plain(docs)), key=repr)


def test_nothing_repeats(spark):
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(5)]
    got = sub.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [r.n_removed for r in got] == [0] * 5
    assert sub.digest(spark.createDataFrame(docs, "doc_id long, text string").limit(0)).collect() == []


def test_a_long_text_that_repeats_itself(spark):
    rng = random.Random(0)
    line = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(20_000))
    docs = [(1, line + " q " + line), (2, "other")]
    assert sorted(map(tuple, sub.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect())) == sorted(plain(docs))


def entries(spark, fps):
    return spark.createDataFrame([(x, x, i, i, 0, 1) for i, x in enumerate(fps)], sub.ENTRY)


def test_runs_merge_and_compact(spark):
    index = sub.Index(spark)
    batches = [[1, 2, 2], [3, 1], [4], [4, 5], [5], [1, 6]]
    found = [sorted(r.fp for r in index.add(entries(spark, b)).collect()) for b in batches]
    assert found == [[2], [1], [], [4], [5], [1]]
    assert len(index.runs) == 6
    with sub.ordered(spark):
        plan = index.met(index.runs[1], index.runs[0])._jdf.queryExecution().executedPlan().toString()
    # Bucket by bucket, in the order that runs have: no shuffle and no sort.
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort " not in plan
    index.compact()
    assert {r.fp: r.times for r in index.run(index.runs[0]).collect()} == Counter(x for b in batches for x in b)
    assert len(index.runs) == 1
    index.clear()
    assert index.runs == []


@pytest.mark.parametrize("fanout", [1, 8])
def test_batches_over_a_kept_index_equal_one_table(spark, tmp_path, monkeypatch, fanout):
    monkeypatch.setattr(sub, "FANOUT", fanout)
    docs = fixture(6)
    random.Random(6).shuffle(docs)
    path = f"file://{tmp_path}/index"
    at = 0
    for size in (30, 40, 0, len(docs) - 70):
        batch = docs[at : at + size]
        at += size
        frame = spark.createDataFrame(batch, "doc_id long, text string").repartition(3)
        got = sub.dedup(frame, index=sub.Index(spark, path)).collect()  # opened anew for each batch
        want = plain(docs[:at])[at - size :]
        assert sorted(((r.key, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got), key=repr) == sorted(want, key=repr)
    index = sub.Index(spark, path)
    assert len(index.runs) == (1 if fanout == 1 else 4) and index.rows().count() == len(docs)
    for name in index.runs:  # another session's catalog knows nothing of the runs
        spark.sql(f"DROP TABLE {name}")
    again = sub.Index(spark, path)
    same = [d for d in docs if d[0] == 202]
    assert [r.n_removed for r in sub.dedup(spark.createDataFrame(same, "doc_id long, text string"), index=again).collect()] == [len(same[0][1].split())]
    again.clear()
    assert not list((tmp_path / "index").glob("*"))


def test_a_failure_leaves_no_runs(spark, monkeypatch):
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(sub.Index, "met", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sub.repeats(spark.createDataFrame(fixture(5), "doc_id long, text string"))
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_fingerprint_in_every_text_is_counted_before_it_is_shuffled(spark):
    index = sub.Index(spark)
    index.add(entries(spark, [7] * 5000 + list(range(100, 200))))
    assert {r.fp: r.times for r in index.run(index.runs[0]).filter("times > 1").collect()} == {7: 5000}
    index.clear()


def test_whole_table_against_sql(spark):
    against_sql(spark, QUERIES["op8_substrings"], sub.ORACLE, "/root/testdata/sf0.001")
