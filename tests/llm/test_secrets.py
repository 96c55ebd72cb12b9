from __future__ import annotations

import hashlib
import math
import re
import time
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import secrets
from millrace.llm.queries import QUERIES, table
from tests_support import against_sql

PLAIN = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def plain(text):
    spans = [(m.start(), m.end(), k) for k, (form, good) in PLAIN.items() for m in form.finditer(text) if good(m)]
    return sorted(spans, key=lambda s: (s[0], list(PLAIN).index(s[2])))


def plain_entropy(text):
    """Unions of windows of 24 characters with enough entropy, every window counted by itself."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{24,}", text):
        run = m[0]
        if secrets.ALLOWED.fullmatch(run):
            continue
        least = 3.0 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) else 3.9 if run.isalnum() else 4.0
        for i in range(len(run) - 23):
            counts = Counter(run[i : i + 24]).values()
            if -sum(c / 24 * math.log2(c / 24) for c in counts) >= least - 1e-9:
                a, b = m.start() + i, m.start() + i + 24
                out = [*out[:-1], (out[-1][0], b)] if out and a <= out[-1][1] else [*out, (a, b)]
    return out


parts = st.sampled_from(["password", "Token", "SECRET", "api_key", "apikey", "passwd", ": ", "=", '"', "'", " ", "abc", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef", "é", "😀", "x+/=", "ſecret", "toKen", "."])


@settings(max_examples=500, deadline=None)
@given(st.lists(parts, max_size=14).map("".join))
def test_base_spans(text):
    assert sorted(secrets.base_spans(text), key=lambda s: (s[0], secrets.KINDS.index(s[2]))) == plain(text)
    assert [s for s in secrets.find(text) if s[2] != "entropy"] == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text("abcdef0123", max_size=60), st.integers(2, 12), st.sampled_from([0.5, 1.5, 2.0, 2.5]))
def test_incremental_counts_give_the_entropy_of_every_window(run, window, least):
    covered = set()
    for i in range(len(run) - window + 1):
        counts = Counter(run[i : i + window]).values()
        if -sum(c / window * math.log2(c / window) for c in counts) <= least - 1e-9 or len(run) < window:
            continue
        covered |= set(range(i, i + window))
    edge = {j for i in range(len(run) - window + 1) for j in range(i, i + window) if abs(-sum(c / window * math.log2(c / window) for c in Counter(run[i : i + window]).values()) - least) < 1e-9}
    got = {j for a, b in secrets.entropy_spans(run, window, least) for j in range(a, b)}
    assert covered <= got <= covered | edge


KEY = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzEXAMPLEKEY1"


def test_entropy_adds_spans_and_the_allow_list_suppresses():
    assert secrets.find(f"see {KEY} here") == [(4, 4 + len(KEY), "entropy")]
    for harmless in ("abcdefghijklmnopqrstuvwxyzabcdef", "123e4567-e89b-12d3-a456-426614174000", "some-long-file-name-2024-with-many-words", "A" * 30 + "1" * 20, "g1" * 30):
        assert secrets.find(f"see {harmless} here") == []
    assert secrets.find("token=" + KEY) == [(0, 6 + len(KEY), "assign"), (0, 6 + len(KEY), "entropy")]
    assert secrets.find("token:" + KEY) == [(0, 6 + len(KEY), "assign"), (6, 6 + len(KEY), "entropy")]


def test_a_secret_beside_a_pattern_in_one_run_is_found():
    hash_ = "0f3a5b7c9d1e2f4a6b8c0d2e4f6a8b1c"
    for text in (f"/{hash_}/{KEY}", f"{KEY}/{hash_}", f"{KEY}=AKIA{'Q7Z2' * 4}", f"xK9/{KEY}token=hunter22"):
        spans, base = secrets.find(text), secrets.base_spans(text)
        assert base and [s for s in spans if s[2] != "entropy"] == base
        at = text.index(KEY)
        assert set(range(at, at + len(KEY))) <= {i for a, b, _ in spans for i in range(a, b)}
    assert secrets.find(f"see {hash_} here") == [(4, 36, "hex"), (4, 36, "entropy")]


def test_a_text_of_many_spans_takes_time_in_proportion():
    many = f"token={KEY} " * 20_000
    start = time.perf_counter()
    assert len(secrets.find(many)) == 40_000
    assert time.perf_counter() - start < 20


def test_entropy_adds_spans_to_a_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r.spans for r in secrets.digest(docs).collect()}
    added = {k: [s for s in spans.split(",") if s.startswith("entropy")] for k, spans in got.items()}
    assert sum(map(len, added.values())) > 0
    for r in docs.collect():
        assert set(added[r.doc_id]) == {f"entropy:{a}:{b}" for a, b in plain_entropy(r.text or "")}


def test_table(spark):
    texts = [None, "", "password = 'hunter22' x", "password=abc", f"é {KEY}", "x " * 50_000 + "AKIA" + "Z" * 16, "password = 'hunter22' x"]
    docs = spark.createDataFrame([(i if i else None, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, secret_spans string")
    got = {(r.doc_id, r.spans): r for r in secrets.digest(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = ",".join(f"{k}:{a}:{b}" for a, b, k in plain(t or ""))
        r = next(r for r in got.values() if r.doc_id == (i or None))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[2] == k for s in plain(t or "")) for k in PLAIN)
    assert secrets.digest(docs.limit(0)).collect() == []


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "a password = 'hunter22' b", 99, "k"), (2, "plain", 5, None), (3, None, None, None)], "doc_id long, text string, n_chars long, other string")
    got = [tuple(r) for r in secrets.redact(docs).orderBy("doc_id").collect()]
    assert got == [(1, "a [SECRET]' b", 13, "k"), (2, "plain", 5, None), (3, None, None, None)]


def test_counts_against_sql(spark):
    against_sql(spark, QUERIES["secret_counts"], secrets.COUNTS, "/root/testdata/sf0.01")
