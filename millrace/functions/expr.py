"""Compiles expression trees to columns.

Every expression has one of the types string, long, double, bool, date, interval and null, found before Spark sees it, because Spark would
cast silently, or raise at run time, where the semantics call for null or for an error at compile time. All functions are
built in; no setting of the session, such as ANSI mode, changes a result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import EvalError, UnknownLookup
from millrace.functions.dates import date_format
from millrace.operators.lookup import Lookup, join_lookup
from millrace.plans.model import Node

#: White space that ``trim`` strips: every character with the Unicode property.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
SPARK = {"string": "string", "long": "bigint", "double": "double", "bool": "boolean", "date": "date", "null": "string"}
_INT_MAX = 2**31 - 1


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def kind_of(t: T.DataType) -> str:
    """The expression type of a column."""
    if isinstance(t, T.StringType):
        return "string"
    if isinstance(t, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return "long"
    if isinstance(t, T.FloatType | T.DoubleType | T.DecimalType):
        return "double"
    if isinstance(t, T.BooleanType):
        return "bool"
    if isinstance(t, T.DateType | T.TimestampType | T.TimestampNTZType):
        return "date"
    if isinstance(t, T.NullType):
        return "null"
    raise EvalError(f"columns of type {t.simpleString()} have no place in expressions")


@dataclass(frozen=True)
class Value:
    """A column and its expression type."""

    column: Column
    kind: str

    def to(self, kind: str) -> Column:
        """The column as another type that holds all its values."""
        if self.kind == kind:
            return self.column
        return self.column.cast(SPARK[kind])


@dataclass(frozen=True)
class Join:
    """A large lookup that is joined before the projection: the column it makes, its input and itself."""

    out: str
    text: Column
    lookup: Lookup


def _number(v: Value, op: str) -> None:
    if v.kind not in ("long", "double", "null"):
        raise EvalError(f"`{op}` takes numbers, not {v.kind}")


def _wider(a: Value, b: Value) -> str:
    """The common type of two numbers."""
    kinds = {a.kind, b.kind} - {"null"}
    return "double" if "double" in kinds or not kinds else "long"


def _add(a: Value, b: Value) -> Value:
    if "string" in (a.kind, b.kind):
        if {a.kind, b.kind} - {"string", "null"}:
            raise EvalError(f"`add` cannot join {a.kind} and {b.kind}")
        return Value(F.concat(a.to("string"), b.to("string")), "string")
    return _arithmetic("add", F.try_add, lambda x, y: x + y)(a, b)


def _sub(a: Value, b: Value) -> Value:
    if a.kind == b.kind == "date":
        return Value(a.column - b.column, "interval")
    return _arithmetic("sub", F.try_subtract, lambda x, y: x - y)(a, b)


def _arithmetic(op: str, exact: Callable[[Column, Column], Column], plain: Callable[[Column, Column], Column]) -> Callable[[Value, Value], Value]:
    """Whole numbers that overflow give null; double arithmetic is IEEE's."""

    def apply(a: Value, b: Value) -> Value:
        _number(a, op)
        _number(b, op)
        kind = _wider(a, b)
        return Value((exact if kind == "long" else plain)(a.to(kind), b.to(kind)), kind)

    return apply


def _div(a: Value, b: Value) -> Value:
    """Whole numbers divide towards zero, by 0 to null; doubles as IEEE has it, zeros with signs included."""
    _number(a, "div")
    _number(b, "div")
    kind = _wider(a, b)
    x, y = a.to(kind), b.to(kind)
    if kind == "long":
        # The one quotient that overflows is null, like the others that have no value.
        bad = (y == 0) | ((y == -1) & (x == F.lit(-(2**63))))
        return Value(F.when(~bad, F.call_function("div", x, F.when(y != 0, y))), "long")
    # Text is the one way to tell -0.0 from 0.0; NaN and 0 times infinity is NaN.
    sign = F.when(y.cast("string").startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return Value(F.when(y == 0, x * sign).otherwise(F.try_divide(x, y)), "double")


def _compare(op: str, apply: Callable[[Column, Column], Column]) -> Callable[[Value, Value], Value]:
    def of(a: Value, b: Value) -> Value:
        numbers = {"long", "double"}
        kinds = {a.kind, b.kind} - {"null"}
        if len(kinds) > 1 and not kinds <= numbers:
            raise EvalError(f"`{op}` cannot compare {a.kind} and {b.kind}")
        kind = _wider(a, b) if kinds & numbers else next(iter(kinds), "string")
        return Value(apply(a.to(kind) if kind in SPARK else a.column, b.to(kind) if kind in SPARK else b.column), "bool")

    return of


def _common(values: list[Value], op: str) -> str:
    """The type of a choice between values: numbers widen, everything else meets as text."""
    kinds = {v.kind for v in values} - {"null"}
    if len(kinds) <= 1:
        return next(iter(kinds), "null")
    if kinds <= {"long", "double"}:
        return "double"
    if "interval" in kinds:
        raise EvalError(f"`{op}` cannot choose between {' and '.join(sorted(kinds))}")
    return "string"


def _text(v: Value, op: str) -> Column:
    if v.kind not in ("string", "null"):
        raise EvalError(f"`{op}` takes text, not {v.kind}")
    return v.to("string")


def _substring(v: Value, start: int, length: int | None) -> Value:
    if length is not None and length < 0:
        raise EvalError("`substring` takes no negative length")
    text = _text(v, "substring")
    n = _INT_MAX if length is None else min(length, _INT_MAX)
    if start >= _INT_MAX:
        return Value(F.when(text.isNotNull(), F.lit("")), "string")
    at = start + 1 if start >= 0 else max(start, -_INT_MAX)
    return Value(F.substring(text, at, n), "string")


def _cast(v: Value, to: str) -> Value:
    """Values that do not fit become null."""
    x, kind = v.column, v.kind
    if kind == "interval":
        raise EvalError(f"cannot cast an interval to {to}")
    if kind == "null":
        target = {"int64": "long", "float64": "double", "string": "string", "date": "date"}[to]
        return Value(x.cast(SPARK[target]), target)
    if to == "int64":
        if kind == "string":
            x = F.when(x.rlike(r"^[+-]?[0-9]+$"), x).try_cast("bigint")
        elif kind == "date":
            x = F.unix_date(x.cast("date")).cast("bigint")
        else:
            x = x.try_cast("bigint")
        return Value(x, "long")
    if to == "float64":
        if kind == "string":
            shape = r"^[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|inf|infinity|nan|Inf|Infinity|NaN)$"
            x = F.when(x.rlike(shape), x).try_cast("double")
        elif kind == "date":
            x = F.unix_date(x.cast("date")).cast("double")
        else:
            x = x.cast("double")
        return Value(x, "double")
    if to == "date":
        if kind == "string":
            x = F.when(x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), x).try_cast("date")
        elif kind == "bool":
            raise EvalError("cannot cast bool to date")
        elif kind != "date":
            x = F.date_from_unix_date(x.try_cast("int"))
        else:
            x = x.cast("date")
        return Value(x, "date")
    return Value(x.cast("string"), "string")


_ADDING = {"add": _add, "sub": _sub, "mul": _arithmetic("mul", F.try_multiply, lambda x, y: x * y), "div": _div}
_COMPARING = {
    "eq": _compare("eq", lambda x, y: x == y),
    "ne": _compare("ne", lambda x, y: x != y),
    "gt": _compare("gt", lambda x, y: x > y),
    "lt": _compare("lt", lambda x, y: x < y),
    "ge": _compare("ge", lambda x, y: x >= y),
    "le": _compare("le", lambda x, y: x <= y),
}


class Compiler:
    """Compiles expressions over one schema, whose columns are named by place: c0, c1 and so on.

    Names of sources may differ in case only, which Spark would not tell apart. ``joins`` collects the large lookups that the
    expressions need joined first.
    """

    def __init__(self, schema: T.StructType, lookups: Mapping[str, Lookup], join_large: bool = True) -> None:
        self.columns = {f.name: (f"c{i}", f.dataType) for i, f in reversed(list(enumerate(schema.fields)))}
        self.lookups = lookups
        self.join_large = join_large
        self.joins: list[Join] = []

    def value(self, node: Node) -> Value:
        k = node.kind
        if k in _ADDING or k in _COMPARING:
            return (_ADDING.get(k) or _COMPARING[k])(self.value(node["left"]), self.value(node["right"]))
        return getattr(self, f"_{k}")(node)

    def _col(self, node: Node) -> Value:
        if node["name"] not in self.columns:
            raise EvalError(f"unknown column `{node['name']}`")
        name, t = self.columns[node["name"]]
        kind, column = kind_of(t), F.col(name)
        # Only the types of the model go on: others are taken in once, here.
        if isinstance(t, T.ByteType | T.ShortType | T.IntegerType | T.FloatType | T.DecimalType):
            column = column.cast(SPARK[kind])
        return Value(column, kind)

    def _str(self, node: Node) -> Value:
        return Value(F.lit(node["value"]), "string")

    def _num(self, node: Node) -> Value:
        return Value(F.lit(float(node["value"])), "double")

    def _bool(self, node: Node) -> Value:
        return Value(F.lit(node["value"]), "bool")

    def _null(self, node: Node) -> Value:
        return Value(F.lit(None), "null")

    def _concat(self, node: Node) -> Value:
        args = [self.value(a) for a in node["args"]]
        if not args:
            raise EvalError("`concat` takes at least one argument")
        return Value(F.concat_ws(node["sep"], *(a.to("string") for a in args)), "string")

    def _upper(self, node: Node) -> Value:
        return Value(F.upper(_text(self.value(node["input"]), "upper")), "string")

    def _lower(self, node: Node) -> Value:
        return Value(F.lower(_text(self.value(node["input"]), "lower")), "string")

    def _trim(self, node: Node) -> Value:
        return Value(F.btrim(_text(self.value(node["input"]), "trim"), F.lit(SPACE)), "string")

    def _substring(self, node: Node) -> Value:
        return _substring(self.value(node["input"]), node["start"], node["length"])

    def _contains(self, node: Node) -> Value:
        return Value(F.contains(_text(self.value(node["input"]), "contains"), _text(self.value(node["pattern"]), "contains")), "bool")

    def _if(self, node: Node) -> Value:
        cond = self.value(node["cond"])
        if cond.kind not in ("bool", "null"):
            raise EvalError(f"`if` takes a condition, not {cond.kind}")
        a, b = self.value(node["then"]), self.value(node["else"])
        kind = _common([a, b], "if")
        pick = lambda v: v.column if kind in ("null", "interval") and v.kind != "null" else v.to(kind) if kind != "interval" else v.column
        return Value(F.when(cond.to("bool"), pick(a)).otherwise(pick(b)), kind)

    def _coalesce(self, node: Node) -> Value:
        args = [v for v in map(self.value, node["args"]) if v.kind != "null"]
        if not args:
            return Value(F.lit(None), "null")
        kind = _common(args, "coalesce")
        return Value(F.coalesce(*(v.to(kind) if kind != "interval" else v.column for v in args)), kind)

    def _parse_date(self, node: Node) -> Value:
        return Value(date_format(node["format"]).parse(_text(self.value(node["input"]), "parse_date")), "date")

    def _lookup_ref(self, node: Node) -> Value:
        lookup = self.lookups.get(node["lookup_id"])
        if lookup is None:
            raise UnknownLookup(node["lookup_id"])
        text = _text(self.value(node["input"]), "lookup_ref")
        if not (self.join_large and lookup.large):
            return Value(lookup.column(text), "string")
        name = f"lookup{len(self.joins)}"
        self.joins.append(Join(name, text, lookup))
        return Value(F.col(name), "string")

    def _cast(self, node: Node) -> Value:
        return _cast(self.value(node["input"]), node["to"])


def project(df: DataFrame, columns: Mapping[str, Node], lookups: Mapping[str, Lookup] | None = None, join_large: bool = True) -> DataFrame:
    """``df`` with the named expressions as its only columns, a row for each row (all-literal expressions too)."""
    compiler = Compiler(df.schema, lookups or {}, join_large)
    # A null of no type is written as text.
    out = [v.to("string").alias(name) if v.kind == "null" else v.column.alias(name) for name, v in ((n, compiler.value(e)) for n, e in columns.items())]
    df = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    for j in compiler.joins:
        df = join_lookup(df, j.text, j.lookup, j.out)
    return df.select(*out)
