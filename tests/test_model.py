from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.errors import ConfigParseError
from millrace.plans import model
from millrace.queries import ORDERS_CONFIG

names = st.from_regex(r"[a-z][a-z0-9_]{0,7}", fullmatch=True)
leaves = st.one_of(
    names.map(lambda n: {"kind": "col", "name": n}),
    st.text(max_size=5).map(lambda s: {"kind": "str", "value": s}),
    st.floats(allow_nan=False, allow_infinity=False).map(lambda x: {"kind": "num", "value": x}),
    st.booleans().map(lambda b: {"kind": "bool", "value": b}),
    st.just({"kind": "null"}),
)


def _grow(inner):
    two = [k for k, f in model.KINDS.items() if set(f) == {"left", "right"}]
    return st.one_of(
        st.tuples(st.sampled_from(two), inner, inner).map(lambda t: {"kind": t[0], "left": t[1], "right": t[2]}),
        st.tuples(st.sampled_from(["upper", "lower", "trim"]), inner).map(lambda t: {"kind": t[0], "input": t[1]}),
        st.lists(inner, max_size=4).map(lambda a: {"kind": "coalesce", "args": a}),
        st.tuples(st.text(max_size=2), st.lists(inner, max_size=4)).map(lambda t: {"kind": "concat", "sep": t[0], "args": t[1]}),
        st.tuples(inner, st.integers(-9, 9), st.none() | st.integers(0, 9)).map(lambda t: {"kind": "substring", "input": t[0], "start": t[1], "length": t[2]}),
        st.tuples(inner, inner, inner).map(lambda t: {"kind": "if", "cond": t[0], "then": t[1], "else": t[2]}),
        st.tuples(inner, st.sampled_from(model.CASTS)).map(lambda t: {"kind": "cast", "input": t[0], "to": t[1]}),
        inner.map(lambda x: {"kind": "parse_date", "input": x, "format": "%Y"}),
        inner.map(lambda x: {"kind": "lookup_ref", "lookup_id": "a.b", "input": x}),
    )


nodes = st.recursive(leaves, _grow, max_leaves=16)


@settings(max_examples=100, deadline=None)
@given(nodes)
def test_expressions_survive_json(doc):
    node = model.parse_node(json.loads(json.dumps(doc)))
    again = model.parse_node(json.loads(json.dumps(model.dump_node(node))))
    assert again == node


def test_config_survives_json():
    config = model.parse_config(ORDERS_CONFIG)
    assert model.parse_config(json.dumps(model.dump(config))) == config


def test_all_kinds_are_there():
    assert len(model.KINDS) == 26


@pytest.mark.parametrize(
    "doc",
    [
        {"kind": "nope"},
        {"name": "x"},
        {"kind": "add", "left": {"kind": "null"}},
        {"kind": "num", "value": "1"},
        {"kind": "num", "value": True},
        {"kind": "cast", "input": {"kind": "null"}, "to": "int32"},
        {"kind": "substring", "input": {"kind": "null"}, "start": 1.5},
        [],
    ],
)
def test_bad_expressions(doc):
    with pytest.raises(ConfigParseError):
        model.parse_node(doc)


def test_unknown_keys_are_ignored_and_missing_ones_are_not():
    doc = json.loads(json.dumps(ORDERS_CONFIG))
    doc["more"] = 1
    doc["mappings"][0]["columns"][0]["expr"]["comment"] = "x"
    assert model.parse_config(doc) == model.parse_config(ORDERS_CONFIG)
    del doc["mappings"][0]["source_container_id"]
    with pytest.raises(ConfigParseError, match="source_container_id"):
        model.parse_config(doc)


def test_substring_length_may_be_left_out():
    node = model.parse_node({"kind": "substring", "input": {"kind": "null"}, "start": 2})
    assert node["length"] is None
