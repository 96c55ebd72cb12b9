from __future__ import annotations

import hashlib
import random
import re

import pytest

from millrace.llm import decontaminate as dc
from millrace.llm.queries import QUERIES, table
from tests_support import against_sql

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found, lines = set(), set(), {}
        for item, other in items:
            b = words(other)
            size = min(10, len(b))
            grams = {}
            for j in range(len(b) - size + 1 if size else 0):
                grams.setdefault(tuple(b[j : j + size]), []).append(j)
            for i in range(len(w) - size + 1 if size else 0):
                if tuple(w[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    if item is not None:
                        found.add(str(item))
                        for j in grams[tuple(w[i : i + size])]:
                            lines.setdefault((item, i - j), []).append((i, i + size))
        most = 0
        for spans in lines.values():
            start = end = -1
            for a, b in sorted(spans):
                start, end = (start, max(end, b)) if a <= end else (a, b)
                most = max(most, end - start)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), most))
    return out


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "ç", "d1", "É", "x"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(6)] + [(90, None), (91, "..."), (None, text(12)), (3, text(14))]
    docs = [(i, text(rng.randint(0, 60)) + (items[i % 6][1] or "") + text(rng.randint(0, 9))) for i in range(60)] + [(None, items[0][1]), (100, None), (101, ""), (102, "zz " * 50_000 + items[5][1])] + [(5, items[1][1])] * 2
    return docs, items


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_against_brute_force(spark, most):
    docs, items = fixture(1)
    got = dc.digest(spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, items string"), spark.createDataFrame(items, "item_id long, text string"), most=most).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(docs, items), key=repr)


def test_longest_matches(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, "x y " + " ".join(f"W{i}" for i in range(5, 27)) + " z"), (2, " ".join(f"w{i}" for i in range(9))), (3, f"{item} q {item}")]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    assert sorted(map(tuple, dc.matches(frame, bench).collect())) == [(1, "7", 5, 2, 22), (3, "7", 0, 0, 30), (3, "7", 0, 31, 30)]


def test_blocks_of_a_large_benchmark_give_what_one_block_gives(spark, monkeypatch):
    monkeypatch.setattr(dc, "WIDE_SHARD_BYTES", 500)
    docs, items = fixture(3)
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id long, text string")
    assert len(dc.blocks(bench, "item_id", "text", 40)) > 3
    for work in (dc.matches, dc.clean):
        one, several = (sorted(map(tuple, work(frame, bench, most=m).collect()), key=repr) for m in (1 << 20, 40))
        assert one == several and one


def test_affected_documents_go_and_clean_ones_stay_as_they_are(spark):
    docs, items = fixture(2)
    frame, bench = spark.createDataFrame([(*d, 1.5) for d in docs], "doc_id long, text string, extra double"), spark.createDataFrame(items, "item_id long, text string")
    clean = [(d, t, 1.5) for (d, t), r in zip(docs, plain(docs, items), strict=True) if not r[5]]
    assert sorted(map(tuple, dc.clean(frame, bench).collect()), key=repr) == sorted(clean, key=repr)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in dc.digest(docs, items).collect()] == [False]
    assert dc.digest(docs.limit(0), items).collect() == []
    assert dc.clean(docs, items).count() == 1


def test_whole_table_against_sql(spark):
    against_sql(spark, QUERIES["op5_decontaminate"], dc.ORACLE, "/root/testdata/sf0.001")
    assert table(spark, "/root/testdata/sf0.001", "benchmark").count() == 40
