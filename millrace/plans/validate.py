"""Config validation: every problem at once, each with a JSON pointer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from millrace.errors import ConfigParseError
from millrace.plans.model import LookupMapping, Mapping, PipelineConfig, parse_config


@dataclass(frozen=True)
class Problem:
    """``kind`` is duplicate_id, dangling_reference, missing_field or schema."""

    kind: str
    path: str
    message: str

    def json(self) -> dict[str, str]:
        return {"kind": self.kind, "message": self.message, "path": self.path}


# The kinds and texts of reports.


def duplicate(path: str, what: str, name: str) -> Problem:
    return Problem("duplicate_id", path, f"duplicate {what} id `{name}` at {path}")


def dangling(path: str, what: str, target: str) -> Problem:
    return Problem("dangling_reference", path, f"dangling {what} reference to `{target}` at {path}")


def missing(path: str, name: str) -> Problem:
    return Problem("missing_field", path, f"missing field `{name}` at {path}")


def schema(path: str, text: str) -> Problem:
    return Problem("schema", path, f"schema error at {path}: {text}")


def not_a_date(column: str, kind: str) -> str:
    return f"partition column `{column}` is type `{kind}`; only `date` columns can be partitioned by month"


def find_lookup(lookups: Sequence[LookupMapping], dotted: str) -> LookupMapping | None:
    """The lookup that a dotted id names: at each level the first with that id."""
    found = None
    for part in dotted.split("."):
        found = next((x for x in lookups if part and x.id == part), None)
        if found is None:
            return None
        lookups = found.children
    return found


def _ids(items: Sequence[Any], where: str, what: str, named: bool) -> Iterator[Problem]:
    seen: set[str] = set()
    for i, x in enumerate(items):
        if not x.id:
            yield missing(f"/{where}/{i}/id", "id")
        elif x.id in seen:
            yield duplicate(f"/{where}/{i}/id", what, x.id)
        seen.add(x.id)
        if named and not x.name:
            yield missing(f"/{where}/{i}/name", "name")


def _mapping(config: PipelineConfig, m: Mapping, at: str) -> Iterator[Problem]:
    source = next((s for s in config.source_containers if s.id == m.source_container_id), None)
    table = next((t for t in config.analytic_tables if t.id == m.analytic_table_id), None)
    if m.source_container_id and source is None:
        yield dangling(f"{at}/source_container_id", "source_container", m.source_container_id)
    if m.analytic_table_id and table is None:
        yield dangling(f"{at}/analytic_table_id", "analytic_table", m.analytic_table_id)
    for j, c in enumerate(m.columns):
        for node in c.expr.walk():
            if node.kind == "lookup_ref" and find_lookup(config.lookup_mappings, node["lookup_id"]) is None:
                yield dangling(f"{at}/columns/{j}/expr", "lookup", node["lookup_id"])
    types = {c.name: c.type for c in reversed(table.schema)} if table else {}
    if table:
        for j, c in enumerate(m.columns):
            if c.name not in types:
                yield dangling(f"{at}/columns/{j}/name", "analytic_table_column", f"{table.id}.{c.name}")
    if by := m.partition_by:
        path = f"{at}/partition_by/column"
        if by.column not in {c.name for c in m.columns}:
            yield dangling(path, "mapping_output_column", by.column)
        elif types.get(by.column, "date") != "date":
            yield schema(path, not_a_date(by.column, types[by.column]))
    if source:
        known = {c.name for c in source.schema}
        for j, c in enumerate(m.columns):
            for node in c.expr.walk():
                if node.kind == "col" and node["name"] not in known:
                    yield dangling(f"{at}/columns/{j}/expr", "source_column", f"{source.id}.{node['name']}")


def validate(config: PipelineConfig) -> list[Problem]:
    """All problems, collections first, then mapping by mapping. An empty reference counts as left open."""
    found = [
        *_ids(config.source_containers, "source_containers", "source_container", True),
        *_ids(config.lookup_mappings, "lookup_mappings", "lookup_mapping", False),
        *_ids(config.mappings, "mappings", "mapping", False),
        *_ids(config.analytic_tables, "analytic_tables", "analytic_table", True),
    ]
    for i, m in enumerate(config.mappings):
        found += _mapping(config, m, f"/mappings/{i}")
    return found


def validate_config(text: str | bytes | dict[str, Any]) -> dict[str, Any]:
    """The report on a config: ``{"ok": True}``, or ``{"ok": False, "errors": [...]}``; JSON that does not parse is a schema error at /."""
    try:
        problems = validate(parse_config(text))
    except ConfigParseError as e:
        return {"ok": False, "errors": [{"kind": "schema", "message": str(e), "path": "/"}]}
    return {"ok": False, "errors": [p.json() for p in problems]} if problems else {"ok": True}
