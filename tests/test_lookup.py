from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.lookup import build_registry, join_lookup
from millrace.plans import model


def tree(doc):
    return model._value(model.LookupMapping, doc, "lookup")


def node(name, *rows, **more):
    return {"id": name, "rows": [{"input_patterns": p, "output": o} | ({"priority": x[0]} if x else {}) for p, o, *x in rows]} | more


def find(doc, text, name=None):
    return build_registry([tree(doc)])[name or doc["id"]].match(text)


@pytest.mark.parametrize(
    ("doc", "text", "want"),
    [
        # Rows as listed, the first that has any pattern in the input.
        (node("k", (["moss"], "green"), (["fern", "moss"], "shade")), "a fern on moss", "green"),
        (node("k", (["Moss"], "green"), case_insensitive=True), "old mOSS here", "green"),
        (node("k", (["Moss"], "green")), "old mOSS here", None),
        # A higher priority comes first, whether or not others are negative or equal.
        (node("k", (["oak"], "tree"), (["leaf", "acorn"], "litter", 3)), "oak leaf", "litter"),
        (node("k", (["oak"], "tree", 2), (["leaf"], "litter", 2)), "leaf of an oak", "tree"),
        (node("k", (["lichen"], "grey", 50), (["oak"], "tree", -50)), "an oak", "tree"),
        (node("k", (["oak"], "early", -7), (["oak"], "plain")), "oak", "plain"),
        # Children come before their parent's rows, whatever the priorities.
        (node("k", (["reed"], "water", 9), children=[node("c", (["reed"], "bank", -9))]), "tall reed", "bank"),
        (node("k", (["reed"], "water"), children=[node("c", (["rush"], "bank"))]), "tall reed", "water"),
        (node("k", (["reed"], "water"), children=[node("c", (["rush"], "bank"), catch_all={"output": "never"})]), "tall reed", "water"),
        # What is left goes to the catch-all of the lookup that was asked, if it has one; null stays null.
        (node("k", (["reed"], "water"), catch_all={"output": "rest"}), "a stone", "rest"),
        (node("k", (["reed"], "water"), catch_all={"output": "rest"}), None, None),
        (node("k", (["reed"], "water")), "a stone", None),
        (node("k", ([""], "all")), "whatever", "all"),
    ],
)
def test_cases(doc, text, want):
    assert find(doc, text) == want


def test_children_have_dotted_ids_and_their_own_catch_all():
    doc = node("k", (["A"], "A"), children=[node("c", (["B"], "B"), catch_all={"output": "REST"}, children=[node("g", (["C"], "C"))])])
    assert find(doc, "zzz", "k.c") == "REST"
    assert find(doc, "xCx", "k.c.g") == "C"
    assert find(doc, "zzz") is None


letters = st.text("abAB", max_size=3)
trees = st.recursive(
    st.fixed_dictionaries({"id": st.just("x"), "case_insensitive": st.booleans(), "rows": st.lists(st.fixed_dictionaries({"input_patterns": st.lists(letters, min_size=1, max_size=3), "output": st.sampled_from("PQRS"), "priority": st.integers(-2, 2)}), max_size=4)}),
    lambda kids: st.tuples(kids, st.lists(kids, max_size=2)).map(lambda t: t[0] | {"children": t[1]}),
    max_leaves=4,
)


def naive(doc, text):
    for child in doc.get("children", []):
        if (hit := naive(child, text)) is not None:
            return hit
    fold = str.lower if doc["case_insensitive"] else str
    hits = [r for r in doc["rows"] if any(fold(p) in fold(text) for p in r["input_patterns"])]
    return max(hits, key=lambda r: r["priority"])["output"] if hits else None


@settings(max_examples=300, deadline=None)
@given(trees, st.text("abAB ", max_size=6))
def test_ranks_do_what_the_tree_says(doc, text):
    assert build_registry([tree(doc)])["x"].match(text) == naive(doc, text)


def test_column_and_join_agree_with_plain_python(spark):
    doc = node("k", *(([f"{n}"], f"o{n}", n % 5) for n in range(40)), (["ab"], "AB", 3), catch_all={"output": "REST"}, case_insensitive=True)
    lookup = build_registry([tree(doc)])["k"]
    texts = [None, "", "7", "xAbx", "3 and 33", "12 ab", "12 ab", "zzz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = [lookup.match(t) for t in texts]
    for most in (1 << 20, 64):  # one block of patterns, and several
        got = join_lookup(df.withColumn("c", lookup.column(F.col("t"))), F.col("t"), lookup, "j", most).orderBy("i").collect()
        assert [r.c for r in got] == want
        assert [r.j for r in got] == want


def test_a_join_over_no_patterns(spark):
    lookup = build_registry([tree(node("k", catch_all={"output": "REST"}))])["k"]
    df = spark.createDataFrame([("a",), (None,)], "t string")
    assert [r.j for r in join_lookup(df, F.col("t"), lookup, "j").collect()] == ["REST", None]
