"""The config model: frozen dataclasses, read from and written to JSON.

Unknown keys are ignored; a key without a default must be there. Expressions are ``Node`` trees, whose kinds and fields ``KINDS`` lists.
"""

from __future__ import annotations

import dataclasses
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any, get_args, get_origin, get_type_hints

from millrace.errors import ConfigParseError

_BINARY = {"left": "node", "right": "node"}
_UNARY = {"input": "node"}

#: Every kind of expression with its fields. A field's form: node, nodes, str, float, bool, int, int? (may be left out) or cast.
KINDS: dict[str, dict[str, str]] = {
    "col": {"name": "str"},
    "str": {"value": "str"},
    "num": {"value": "float"},
    "bool": {"value": "bool"},
    "null": {},
    "add": _BINARY,
    "sub": _BINARY,
    "mul": _BINARY,
    "div": _BINARY,
    "concat": {"sep": "str", "args": "nodes"},
    "upper": _UNARY,
    "lower": _UNARY,
    "trim": _UNARY,
    "substring": {"input": "node", "start": "int", "length": "int?"},
    "eq": _BINARY,
    "ne": _BINARY,
    "gt": _BINARY,
    "lt": _BINARY,
    "ge": _BINARY,
    "le": _BINARY,
    "contains": {"input": "node", "pattern": "node"},
    "if": {"cond": "node", "then": "node", "else": "node"},
    "coalesce": {"args": "nodes"},
    "parse_date": {"input": "node", "format": "str"},
    "lookup_ref": {"lookup_id": "str", "input": "node"},
    "cast": {"input": "node", "to": "cast"},
}
CASTS = ("int64", "float64", "string", "date")
_INT64 = range(-(2**63), 2**63)


@dataclass(frozen=True)
class Node:
    """One expression: its kind and its fields."""

    kind: str
    fields: dict[str, Any] = field(default_factory=dict, hash=False)

    def __getitem__(self, name: str) -> Any:
        return self.fields.get(name)

    def children(self) -> Iterator[Node]:
        for name, form in KINDS[self.kind].items():
            if form == "node":
                yield self.fields[name]
            elif form == "nodes":
                yield from self.fields[name]

    def walk(self) -> Iterator[Node]:
        """This node and all below it, parents first."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(list(node.children())))


def _want(ok: bool, where: str, what: str) -> None:
    if not ok:
        raise ConfigParseError(f"{where}: expected {what}")


def _is_int(x: Any) -> bool:
    return isinstance(x, int) and not isinstance(x, bool)


def parse_node(doc: Any, where: str = "expr") -> Node:
    _want(isinstance(doc, dict), where, "an object")
    kind = doc.get("kind")
    if kind not in KINDS:
        raise ConfigParseError(f"{where}: unknown expression kind {json.dumps(kind)}")
    out: dict[str, Any] = {}
    for name, form in KINDS[kind].items():
        at = f"{where}.{name}"
        if name not in doc or (form == "int?" and doc[name] is None):
            if form == "int?":
                out[name] = None
                continue
            raise ConfigParseError(f"{where}: missing field `{name}`")
        x = doc[name]
        if form == "node":
            x = parse_node(x, at)
        elif form == "nodes":
            _want(isinstance(x, list), at, "a list")
            x = tuple(parse_node(a, f"{at}[{i}]") for i, a in enumerate(x))
        elif form == "str":
            _want(isinstance(x, str), at, "a string")
        elif form == "bool":
            _want(isinstance(x, bool), at, "a boolean")
        elif form == "float":
            _want(_is_int(x) or isinstance(x, float), at, "a number")
            x = float(x)
            _want(math.isfinite(x), at, "a finite number")
        elif form in ("int", "int?"):
            _want(_is_int(x) and x in _INT64, at, "a 64-bit integer")
        else:
            _want(x in CASTS, at, f"one of {', '.join(CASTS)}")
        out[name] = x
    return Node(kind, out)


def dump_node(node: Node) -> dict[str, Any]:
    out: dict[str, Any] = {"kind": node.kind}
    for name, form in KINDS[node.kind].items():
        x = node.fields[name]
        out[name] = dump_node(x) if form == "node" else [dump_node(a) for a in x] if form == "nodes" else x
    return out


@dataclass(frozen=True)
class ColumnAssertions:
    not_null: bool | None = None
    unique: bool | None = None
    accepted_values: list[str] | None = None
    min: float | None = None
    max: float | None = None


@dataclass(frozen=True)
class ColumnSchema:
    name: str
    type: str
    nullable: bool | None = None
    assertions: ColumnAssertions | None = None


@dataclass(frozen=True)
class SourceContainer:
    id: str
    name: str
    path_prefix: str
    schema: list[ColumnSchema]


@dataclass(frozen=True)
class LookupRow:
    input_patterns: list[str]
    output: str
    priority: int = 0


@dataclass(frozen=True)
class LookupCatchAll:
    output: str


@dataclass(frozen=True)
class LookupMapping:
    id: str
    rows: list[LookupRow]
    name: str | None = None
    match: str | None = None
    case_insensitive: bool | None = None
    children: list[LookupMapping] = field(default_factory=list)
    catch_all: LookupCatchAll | None = None


@dataclass(frozen=True)
class PartitionBy:
    column: str
    granularity: str


@dataclass(frozen=True)
class MappingColumn:
    name: str
    expr: Node


@dataclass(frozen=True)
class Mapping:
    id: str
    source_container_id: str
    analytic_table_id: str
    columns: list[MappingColumn]
    name: str = ""
    partition_by: PartitionBy | None = None


@dataclass(frozen=True)
class AnalyticTable:
    id: str
    name: str
    output_prefix: str
    schema: list[ColumnSchema]


@dataclass(frozen=True)
class LayoutPosition:
    x: float
    y: float


@dataclass(frozen=True)
class PipelineConfig:
    version: int
    source_containers: list[SourceContainer]
    lookup_mappings: list[LookupMapping]
    mappings: list[Mapping]
    analytic_tables: list[AnalyticTable]
    layout: dict[str, LayoutPosition] = field(default_factory=dict)


def _value(kind: Any, doc: Any, where: str) -> Any:
    args = get_args(kind)
    if type(None) in args:
        return None if doc is None else _value(next(a for a in args if a is not type(None)), doc, where)
    if kind is Node:
        return parse_node(doc, where)
    if dataclasses.is_dataclass(kind):
        return _parse(kind, doc, where)
    if get_origin(kind) is list:
        _want(isinstance(doc, list), where, "a list")
        return [_value(args[0], x, f"{where}[{i}]") for i, x in enumerate(doc)]
    if get_origin(kind) is dict:
        _want(isinstance(doc, dict), where, "an object")
        return {k: _value(args[1], x, f"{where}.{k}") for k, x in doc.items()}
    if kind is float:
        _want(_is_int(doc) or isinstance(doc, float), where, "a number")
        return float(doc)
    if kind is int:
        _want(_is_int(doc) and doc in _INT64, where, "an integer")
        return doc
    _want(isinstance(doc, kind), where, {"str": "a string", "bool": "a boolean"}[kind.__name__])
    return doc


def _parse(cls: type, doc: Any, where: str) -> Any:
    _want(isinstance(doc, dict), where, "an object")
    hints = get_type_hints(cls)
    got = {}
    for f in dataclasses.fields(cls):
        if f.name in doc:
            got[f.name] = _value(hints[f.name], doc[f.name], f"{where}.{f.name}")
        elif f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING:
            raise ConfigParseError(f"{where}: missing field `{f.name}`")
    return cls(**got)


def parse_config(doc: str | bytes | dict[str, Any]) -> PipelineConfig:
    """A config from JSON text or a decoded document; ConfigParseError says where it does not fit."""
    if isinstance(doc, str | bytes):
        try:
            doc = json.loads(doc)
        except ValueError as e:
            raise ConfigParseError(str(e)) from e
    config = _parse(PipelineConfig, doc, "config")
    _want(0 <= config.version < 2**32, "config.version", "an unsigned 32-bit integer")
    return config


def dump(x: Any) -> Any:
    """The JSON document of a config or part of one; optional parts that are unset are left out."""
    if isinstance(x, Node):
        return dump_node(x)
    if dataclasses.is_dataclass(x):
        return {f.name: dump(v) for f in dataclasses.fields(x) if (v := getattr(x, f.name)) is not None}
    if isinstance(x, list):
        return [dump(v) for v in x]
    if isinstance(x, dict):
        return {k: dump(v) for k, v in x.items()}
    return x
