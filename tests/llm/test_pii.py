from __future__ import annotations

import hashlib
import random
import re

from millrace.llm import pii
from millrace.llm.queries import QUERIES
from tests_support import against_sql

FORMS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: luhn(s)),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15),
)


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return 14 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def plain(text):
    spans = [(m.start(), i, k, m.end()) for i, (k, form, good) in enumerate(FORMS) for m in form.finditer(text) if good(m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def random_texts(n):
    rng = random.Random(5)
    alphabets = ["0123456789 -.", "12.@ab- +()", "a@b.c_-% 1", "+1 ()-.23é😀", "4111 -", "0123456789", "255.0 1"]
    return ["".join(rng.choice(a) for _ in range(rng.randint(0, 120))) for a in (rng.choice(alphabets) for _ in range(n))]


def test_base_spans_equal_those_of_the_plain_patterns(spark):
    long = "4111-1111-1111-1111 a@b.co +1 (017) 555-7713 1.2.3.4 " * 400
    texts = [None, "", long, "a.b" * 20_000 + "@x" + ".y" * 9_000, "1 " * 30_000, *random_texts(1500)]
    docs = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = plain(t or "")
        r = got[i or None]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want.split(",")) for k, _, _ in FORMS]


INSTANCE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]|(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])|(?<!\S)[^\s0-9@]*[0-9@]\S*", re.A)
SEED = [f for k, f, _ in FORMS if k == "email"][0]


def is_seed(core, match):
    ip = re.fullmatch(r"[0-9]+(\.[0-9]+){3}", core) and all(int(x) <= 255 for x in core.split("."))
    card = re.fullmatch(r"[0-9]([\x20-]?[0-9])+", core) and luhn(core)
    phone = FORMS[3][1].search(match) and FORMS[3][2](match)
    return bool(SEED.search(core) or ip or card or phone)


def plain_context(texts):
    """Each text's context spans, by a model of the graph in plain Python."""
    found, seeds, graph = [], set(), {}
    for t in texts:
        t = t or ""
        at = list(INSTANCE.finditer(t))
        edges = [0, *(x for m in at for x in m.span()), len(t)]
        own = []
        for i, m in enumerate(at):
            core = m[0].strip(pii.EDGE)
            if len(core) < pii.LEAST:
                continue
            gaps = t[edges[2 * i] : m.start()], t[m.end() : edges[2 * i + 3]]
            left, right = (([*g.split()] or [""])[k].strip(pii.EDGE).lower() for g, k in zip(gaps, (-1, 0), strict=True))
            own.append((m.start() + len(m[0]) - len(m[0].lstrip(pii.EDGE)), core))
            sides = [("left", left)] * any(map(str.isalpha, left)) + [("right", right)] * any(map(str.isalpha, right))
            for name in [*sides, *([("both", left, right)] if len(sides) == 2 else [])]:
                graph.setdefault(name, set()).add(core)
            seeds |= {core} if is_seed(core, m[0]) else set()
        found.append(own)
    score = {c: float(c in seeds) for own in found for _, c in own}
    for _ in range(200):
        trust = {p: sum(score[c] for c in of) / (len(of) + 1) for p, of in graph.items() if sum(score[c] >= pii.CONFIDENT for c in of) >= pii.SUPPORT}
        trusted = {p: t for p, t in trust.items() if t >= pii.CONFIDENT}
        wrong = dict.fromkeys(score, 1.0)
        for p, t in trusted.items():
            for c in graph[p]:
                wrong[c] *= 1 - t
        score = {c: 1.0 if c in seeds else 1 - wrong[c] for c in score}
    return [",".join(f"context:{a}:{a + len(c)}" for a, c in own if c not in seeds and score[c] >= pii.CONFIDENT) for own in found]


def context(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [",".join(x for x in r.spans.split(",") if x.startswith("context")) for r in pii.digest(docs).orderBy("doc_id").collect()]


MAILS = [f"mail u{i}@site{i % 5}.example.org now" for i in range(14)]


def test_contexts_discover_what_the_patterns_miss(spark):
    cards = [str(n) for n in range(4111111111111111, 4111111111111111 + 200) if luhn(str(n))][:14]
    wrong = ["4999999999999993", "4888888888888882"]
    assert not any(map(luhn, wrong))
    texts = [f"his card {c} was" for c in cards] + [f"her card {wrong[0]} was", f"order {wrong[1]} came", f"again {wrong[0]}, yes"]
    texts += [*MAILS, "mail zoe99 now", "mail: zoe(at)site9.example.org today", "order 77711 came now"]
    got = context(spark, texts)
    assert got[14] == "context:9:25"  # after the same word, but the check digit is wrong
    assert got[15] == ""  # other words around it
    assert got[16] == "context:6:22"  # the same identifier, wherever it stands
    assert got[-3:] == ["context:5:10", "context:6:30", ""]  # forms that no pattern has
    assert got == plain_context(texts)


def test_phones_with_blanks_are_seeds_and_discoveries_support_others(spark):
    calls = [f"call +1 (131) 555-{1000 + i} today" for i in range(16)]
    # Known and new identifiers in the second context are confident by the first alone; together they support the second.
    second = [f"reach {x} soon" for x in ("x-1001-22", "x-1002-22", "x-1003-22")]
    texts = [*calls, *(f"call {x} today" for x in ("x-1001-22", "x-1002-22", "x-1003-22")), *second, "reach y-1004-33 soon", "see y-1005-33 soon"]
    got = context(spark, texts)
    assert got[16] == "context:5:14" and got == plain_context(texts)


def test_random_graphs_score_as_in_the_plain_model(spark):
    rng = random.Random(11)
    words = ["mail", "Call", "to", "the", "é", "from:", "9"]
    things = [*(f"u{i}@a.example" for i in range(12)), *(f"id-{i}00x" for i in range(6)), "10.0.0.1", "+1 222 333 4444", "x" * 90 + "1"]
    texts = [None, "", "w" * 200 + " " * 100 + "12345 " + "w" * 200]
    for _ in range(400):
        parts = [rng.choice(words[: rng.randint(1, 7)]) if rng.random() < 0.6 else rng.choice(things) for _ in range(rng.randint(1, 9))]
        # One word stands before identifiers mostly, known ones or not.
        parts += ["write", rng.choice(things[: rng.choice([12, 12, 12, 14])])] * rng.randint(0, 1)
        texts.append(rng.choice([" ", "  ", "\n"]).join(parts))
    want = plain_context(texts)
    assert any(want) and context(spark, texts) == want


def test_every_third_row_holds_one_identifier(spark):
    texts = [*MAILS, "mail zoe99 now", *(f"row {i} zoe99" if i % 3 else "zoe99" for i in range(300))]
    assert context(spark, texts) == plain_context(texts)


def test_rows_that_repeat_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a@b.co")] * 3 + [(None, "a@b.co")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.spans) for r in pii.digest(docs).collect()) == [(0, "email:0:6"), *[(1, "email:0:6")] * 3]
    assert pii.digest(docs.limit(0)).collect() == []


def test_the_plan_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    plan = pii.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_counts_against_sql(spark):
    against_sql(spark, QUERIES["pii_counts"], pii.COUNTS, "/root/testdata/sf0.01")
