"""Properties of configs and headers, over generated ones."""

from __future__ import annotations

import copy

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.plans.model import ColumnSchema
from millrace.plans.validate import validate_config
from millrace.sources.csv import missing_columns, resolve_container
from millrace.sources.parquet import partition_key

ids = st.from_regex(r"[a-z][a-z0-9_]{0,7}", fullmatch=True)


@st.composite
def configs(draw):
    """Valid configs with one to three sources, tables and mappings and up to three lookups."""
    sources = [{"id": i, "name": i, "path_prefix": f"raw/{i}/", "schema": [{"name": c, "type": "string"} for c in draw(st.lists(ids, min_size=1, max_size=3, unique=True))]} for i in draw(st.lists(ids, min_size=1, max_size=3, unique=True))]
    lookups = [{"id": i, "rows": [{"input_patterns": ["x"], "output": "y"}], "children": [{"id": "kid", "rows": []}]} for i in draw(st.lists(ids, max_size=3, unique=True))]
    tables = [{"id": i, "name": i, "output_prefix": "", "schema": [{"name": "d", "type": "date"}, *({"name": c, "type": "string"} for c in draw(st.lists(ids.filter(lambda s: s != "d"), min_size=1, max_size=3, unique=True)))]} for i in draw(st.lists(ids, min_size=1, max_size=3, unique=True))]
    mappings = []
    for i in draw(st.lists(ids, min_size=1, max_size=3, unique=True)):
        source, table = draw(st.sampled_from(sources)), draw(st.sampled_from(tables))
        column = lambda source=source: {"kind": "col", "name": draw(st.sampled_from(source["schema"]))["name"]}
        exprs = []
        for c in table["schema"]:
            e = column()
            if lookups and draw(st.booleans()):
                e = {"kind": "lookup_ref", "lookup_id": draw(st.sampled_from(lookups))["id"] + draw(st.sampled_from(["", ".kid"])), "input": e}
            exprs.append({"name": c["name"], "expr": {"kind": "parse_date", "input": e, "format": "%Y"} if c["name"] == "d" else e})
        by = {"partition_by": {"column": "d", "granularity": "month"}} if draw(st.booleans()) else {}
        mappings.append({"id": i, "source_container_id": source["id"], "analytic_table_id": table["id"], "columns": exprs} | by)
    return {"version": 1, "source_containers": sources, "lookup_mappings": lookups, "mappings": mappings, "analytic_tables": tables}


CHANGES = (
    ("duplicate_id", lambda d: d["source_containers"].append(copy.deepcopy(d["source_containers"][0]))),
    ("missing_field", lambda d: d["mappings"][0].update(id="")),
    ("dangling_reference", lambda d: d["mappings"][0].update(source_container_id="NOWHERE")),
    ("dangling_reference", lambda d: d["mappings"][0].update(analytic_table_id="NOWHERE")),
    ("dangling_reference", lambda d: d["mappings"][0]["columns"][0].update(expr={"kind": "lookup_ref", "lookup_id": "NOWHERE", "input": {"kind": "null"}})),
    ("dangling_reference", lambda d: d["mappings"][0]["columns"][0].update(expr={"kind": "upper", "input": {"kind": "col", "name": "NOWHERE"}})),
    ("schema", lambda d: d["mappings"][0].update(partition_by={"column": d["mappings"][0]["columns"][1]["name"], "granularity": "month"})),
)


@settings(max_examples=100, deadline=None)
@given(configs(), st.sampled_from(CHANGES))
def test_valid_configs_pass_and_broken_ones_do_not(config, change):
    assert validate_config(config) == {"ok": True}
    kind, apply = change
    apply(config)
    report = validate_config(config)
    assert not report["ok"]
    assert kind in {e["kind"] for e in report["errors"]}


@settings(max_examples=200, deadline=None)
@given(st.lists(ids, unique=True), st.lists(ids, unique=True))
def test_missing_headers(headers, declared):
    missing = missing_columns(headers, [ColumnSchema(n, "string") for n in declared])
    assert missing == [n for n in declared if n not in headers]


@settings(max_examples=100, deadline=None)
@given(configs(), st.data())
def test_a_key_belongs_to_the_first_container_that_it_starts_with(config, data):
    from millrace.plans.model import parse_config

    containers = parse_config(config).source_containers
    one = data.draw(st.sampled_from(containers))
    found = resolve_container(one.path_prefix + "x.csv", containers)
    assert found == next(c for c in containers if (one.path_prefix + "x.csv").startswith(c.path_prefix))


@given(st.integers(0, 9999), st.integers(1, 12))
def test_keys_sort_as_months_do(year, month):
    key = partition_key("t", "m", year, month)
    assert (key < partition_key("t", "m", 5000, 6)) == ((year, month) < (5000, 6))
