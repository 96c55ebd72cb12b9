from __future__ import annotations

import copy

import pytest

from millrace.plans.validate import validate_config

LINE = {"kind": "col", "name": "line"}
SHELVES = {
    "id": "shelf",
    "rows": [{"input_patterns": ["pot", "soil"], "output": "outside"}, {"input_patterns": ["seed"], "output": "drawer", "priority": 2}],
    "catch_all": {"output": "counter"},
    "children": [{"id": "plants", "rows": [], "children": [{"id": "ferns", "case_insensitive": True, "rows": [{"input_patterns": ["bracken"], "output": "shade"}]}]}],
}
BASE = {
    "version": 1,
    "source_containers": [{"id": "till", "name": "Till", "path_prefix": "in/till/", "schema": [{"name": "line", "type": "string"}, {"name": "cents", "type": "int64"}]}],
    "lookup_mappings": [SHELVES],
    "mappings": [
        {
            "id": "stock",
            "source_container_id": "till",
            "analytic_table_id": "goods",
            "columns": [
                {"name": "place", "expr": {"kind": "lookup_ref", "lookup_id": "shelf", "input": dict(LINE)}},
                {"name": "fern", "expr": {"kind": "lookup_ref", "lookup_id": "shelf.plants.ferns", "input": dict(LINE)}},
                {"name": "cents", "expr": {"kind": "col", "name": "cents"}},
            ],
        }
    ],
    "analytic_tables": [{"id": "goods", "name": "Goods", "output_prefix": "", "schema": [{"name": "place", "type": "string"}, {"name": "fern", "type": "string"}, {"name": "cents", "type": "int64"}]}],
}


def changed(change):
    doc = copy.deepcopy(BASE)
    change(doc)
    return validate_config(doc)


def test_valid():
    assert validate_config(BASE) == {"ok": True}


def test_no_lookups_at_all():
    def change(d):
        d["lookup_mappings"] = []
        for c in d["mappings"][0]["columns"]:
            c["expr"] = dict(LINE)

    assert changed(change) == {"ok": True}


def _lookup(name):
    return lambda d: d["mappings"][0]["columns"][0]["expr"].update(lookup_id=name)


@pytest.mark.parametrize(
    ("change", "kind", "path", "words"),
    [
        (lambda d: d["source_containers"].append(d["source_containers"][0]), "duplicate_id", "/source_containers/1/id", "source_container id `till`"),
        (lambda d: d["mappings"][0].update(source_container_id="missing"), "dangling_reference", "/mappings/0/source_container_id", "source_container reference to `missing`"),
        (lambda d: d["mappings"][0].update(analytic_table_id="gone"), "dangling_reference", "/mappings/0/analytic_table_id", "analytic_table reference to `gone`"),
        (_lookup("none"), "dangling_reference", "/mappings/0/columns/0/expr", "lookup reference to `none`"),
        (_lookup("shelf.none"), "dangling_reference", "/mappings/0/columns/0/expr", "shelf.none"),
        (_lookup("shelf."), "dangling_reference", "/mappings/0/columns/0/expr", "shelf."),
        (lambda d: d["source_containers"][0].update(name=""), "missing_field", "/source_containers/0/name", "name"),
        (lambda d: d["analytic_tables"][0]["schema"].pop(), "dangling_reference", "/mappings/0/columns/2/name", "analytic_table_column reference to `goods.cents`"),
        (lambda d: d["mappings"][0].update(partition_by={"column": "ghost", "granularity": "month"}), "dangling_reference", "/mappings/0/partition_by/column", "mapping_output_column"),
        (lambda d: d["mappings"][0].update(partition_by={"column": "place", "granularity": "month"}), "schema", "/mappings/0/partition_by/column", "`place`"),
        (lambda d: d["mappings"][0]["columns"][0]["expr"]["input"].update(name="nope"), "dangling_reference", "/mappings/0/columns/0/expr", "source_column reference to `till.nope`"),
    ],
)
def test_one_problem(change, kind, path, words):
    (error,) = changed(change)["errors"]
    assert (error["kind"], error["path"]) == (kind, path)
    assert words in error["message"]


def test_empty_ids_are_missing_and_empty_references_open():
    def change(d):
        d["source_containers"][0]["id"] = ""
        d["mappings"][0]["source_container_id"] = ""

    assert changed(change)["errors"] == [{"kind": "missing_field", "path": "/source_containers/0/id", "message": "missing field `id` at /source_containers/0/id"}]


def test_not_json():
    report = validate_config("not json")
    assert not report["ok"]
    assert (report["errors"][0]["kind"], report["errors"][0]["path"]) == ("schema", "/")
