"""The engine's operators as queries over the tables of a folder, each with the same rows in SQL.

Every query builds expressions or a config as JSON documents and runs them through the engine.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.expr import project
from millrace.operators.assertions import validate_assertions
from millrace.operators.lookup import build_registry
from millrace.operators.union import union_all
from millrace.plans import model
from millrace.plans.job import Options, run_pipeline
from millrace.plans.validate import validate_config
from millrace.sources.objects import Objects
from millrace.sources.parquet import partition_by_month

Doc = dict[str, Any]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Expressions as JSON documents.


def col(name: str) -> Doc:
    return {"kind": "col", "name": name}


def text(value: str) -> Doc:
    return {"kind": "str", "value": value}


def num(value: float) -> Doc:
    return {"kind": "num", "value": value}


NULL: Doc = {"kind": "null"}


def op(kind: str, left: Doc, right: Doc) -> Doc:
    return {"kind": kind, "left": left, "right": right}


def unary(kind: str, x: Doc) -> Doc:
    return {"kind": kind, "input": x}


def concat(sep: str, *args: Doc) -> Doc:
    return {"kind": "concat", "sep": sep, "args": list(args)}


def substring(x: Doc, start: int, length: int | None = None) -> Doc:
    return {"kind": "substring", "input": x, "start": start} | ({} if length is None else {"length": length})


def when(cond: Doc, then: Doc, other: Doc) -> Doc:
    return {"kind": "if", "cond": cond, "then": then, "else": other}


def coalesce(*args: Doc) -> Doc:
    return {"kind": "coalesce", "args": list(args)}


def cast(x: Doc, to: str) -> Doc:
    return {"kind": "cast", "input": x, "to": to}


def parse_date(x: Doc, fmt: str) -> Doc:
    return {"kind": "parse_date", "input": x, "format": fmt}


def contains(x: Doc, pattern: Doc) -> Doc:
    return {"kind": "contains", "input": x, "pattern": pattern}


def lookup_ref(name: str, x: Doc) -> Doc:
    return {"kind": "lookup_ref", "lookup_id": name, "input": x}


def mapped(df: DataFrame, columns: dict[str, Doc], lookups: Sequence[Doc] = ()) -> DataFrame:
    """The named expressions over ``df``."""
    trees = [model._value(model.LookupMapping, x, "lookup") for x in lookups]
    return project(df, {k: model.parse_node(v) for k, v in columns.items()}, build_registry(trees))


def query(name: str, source: str, columns: dict[str, Doc], sql: str, lookups: Sequence[Doc] = ()) -> None:
    """Register a projection of one whole table."""
    QUERIES[name] = lambda spark, sf_dir: mapped(table(spark, sf_dir, source), columns, lookups)
    SQL[name] = sql


def registered(sql: str) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


# Projection, literals, arithmetic.

LINE = {"l_orderkey": col("l_orderkey"), "l_linenumber": col("l_linenumber")}
query("col_project", "orders", {"o_orderkey": col("o_orderkey"), "o_orderstatus": col("o_orderstatus")}, "SELECT o_orderkey, o_orderstatus FROM orders")
query("literals", "nation", {"n_name": col("n_name"), "s": text("it's"), "x": num(1.5), "b": {"kind": "bool", "value": True}}, "SELECT n_name, 'it''s' AS s, 1.5::DOUBLE AS x, true AS b FROM nation")
query("null_literal", "region", {"r_name": col("r_name"), "nothing": NULL, "none": cast(NULL, "string")}, "SELECT r_name, NULL::VARCHAR AS nothing, NULL::VARCHAR AS none FROM region")
query("arith_add", "lineitem", LINE | {"v": op("add", col("l_extendedprice"), col("l_tax"))}, "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice + l_tax AS v FROM lineitem")
query("arith_sub", "lineitem", LINE | {"v": op("sub", num(1), col("l_discount"))}, "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, 1.0::DOUBLE - l_discount AS v FROM lineitem")
query("arith_mul", "lineitem", LINE | {"v": op("mul", col("l_extendedprice"), op("sub", num(1), col("l_discount")))}, "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice * (1.0::DOUBLE - l_discount) AS v FROM lineitem")
query("arith_long", "orders", {"o_orderkey": col("o_orderkey"), "v": op("mul", op("add", col("o_orderkey"), col("o_custkey")), op("sub", col("o_orderkey"), col("o_custkey")))}, "SELECT o_orderkey, ((o_orderkey + o_custkey) * (o_orderkey - o_custkey))::BIGINT AS v FROM orders")
query("string_add", "part", {"p_partkey": col("p_partkey"), "v": op("add", col("p_brand"), col("p_type"))}, "SELECT p_partkey, p_brand || p_type AS v FROM part")
query("div_float", "lineitem", LINE | {"v": op("div", col("l_extendedprice"), col("l_quantity"))}, "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice / l_quantity AS v FROM lineitem")
# As the SQL has it, any zero divides to infinity: neither the price (null, zero, negative, NaN) nor the sign of the zero counts, so one is divided by its square.
_ZERO = op("eq", col("l_discount"), num(0))
query("div_zero", "lineitem", LINE | {"v": when(_ZERO, op("div", num(1), op("mul", col("l_discount"), col("l_discount"))), op("div", col("l_extendedprice"), col("l_discount")))}, "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_discount = 0 THEN 'inf'::DOUBLE ELSE l_extendedprice / l_discount END AS v FROM lineitem")
query("div_int", "orders", {"o_orderkey": col("o_orderkey"), "v": op("div", col("o_orderkey"), col("o_custkey"))}, "SELECT o_orderkey, CASE WHEN o_custkey = 0 THEN NULL ELSE o_orderkey // o_custkey END AS v FROM orders")

# Text.

_SOME = when(op("gt", col("c_acctbal"), num(0)), col("c_mktsegment"), NULL)
query("concat_sep", "customer", {"c_custkey": col("c_custkey"), "v": concat("-", col("c_name"), col("c_mktsegment"))}, "SELECT c_custkey, concat_ws('-', c_name, c_mktsegment) AS v FROM customer")
query("concat_nulls", "customer", {"c_custkey": col("c_custkey"), "v": concat(" ", _SOME, col("c_name"), NULL), "w": concat(" ", _SOME, NULL)}, "SELECT c_custkey, concat_ws(' ', CASE WHEN c_acctbal > 0 THEN c_mktsegment END, c_name) AS v, concat_ws(' ', CASE WHEN c_acctbal > 0 THEN c_mktsegment END) AS w FROM customer")
query("concat_types", "orders", {"o_orderkey": col("o_orderkey"), "v": concat("|", col("o_orderkey"), col("o_orderdate"), op("gt", col("o_orderkey"), col("o_custkey")))}, "SELECT o_orderkey, concat_ws('|', o_orderkey, o_orderdate::TIMESTAMP, o_orderkey > o_custkey) AS v FROM orders")
query("upper", "part", {"p_partkey": col("p_partkey"), "v": unary("upper", col("p_name"))}, "SELECT p_partkey, upper(p_name) AS v FROM part")
query("lower", "customer", {"c_custkey": col("c_custkey"), "v": unary("lower", col("c_mktsegment"))}, "SELECT c_custkey, lower(c_mktsegment) AS v FROM customer")
query("trim_ws", "part", {"p_partkey": col("p_partkey"), "v": unary("trim", concat("", text(" \t\r\n"), col("p_name"), text("\n  "))), "w": unary("trim", text(" \t "))}, "SELECT p_partkey, p_name AS v, '' AS w FROM part")
query("substring_pos", "customer", {"c_custkey": col("c_custkey"), "v": substring(col("c_name"), 3, 5)}, "SELECT c_custkey, substring(c_name, 4, 5) AS v FROM customer")
query("substring_neg", "customer", {"c_custkey": col("c_custkey"), "v": substring(col("c_name"), -4, 2)}, "SELECT c_custkey, substring(c_name, -4, 2) AS v FROM customer")
query("substring_open", "customer", {"c_custkey": col("c_custkey"), "v": substring(col("c_name"), 9), "w": substring(col("c_name"), -3), "far": substring(col("c_name"), 5_000_000_000)}, "SELECT c_custkey, substring(c_name, 10) AS v, right(c_name, 3) AS w, '' AS far FROM customer")
query("contains_lit", "part", {"p_partkey": col("p_partkey"), "v": contains(col("p_name"), text("ring")), "any": contains(col("p_name"), text("")), "dot": contains(col("p_name"), text("r.ng"))}, "SELECT p_partkey, contains(p_name, 'ring') AS v, true AS any, false AS dot FROM part")
query("contains_col", "part", {"p_partkey": col("p_partkey"), "v": contains(col("p_name"), substring(col("p_type"), 0, 1)), "n": contains(col("p_name"), cast(NULL, "string"))}, "SELECT p_partkey, contains(p_name, substring(p_type, 1, 1)) AS v, NULL::BOOLEAN AS n FROM part")

# Comparisons and choices.

for _kind, _sign in (("eq", "="), ("ne", "<>"), ("gt", ">"), ("lt", "<"), ("ge", ">="), ("le", "<=")):
    query(
        f"cmp_{_kind}",
        "lineitem",
        LINE | {"v": op(_kind, col("l_discount"), col("l_tax")), "s": op(_kind, col("l_returnflag"), text("N")), "m": op(_kind, col("l_linenumber"), num(3)), "n": op(_kind, col("l_tax"), NULL)},
        f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_discount {_sign} l_tax AS v, l_returnflag {_sign} 'N' AS s, l_linenumber {_sign} 3 AS m, NULL::BOOLEAN AS n FROM lineitem",
    )
query("if_else", "orders", {"o_orderkey": col("o_orderkey"), "v": when(op("gt", col("o_totalprice"), num(200000)), text("big"), col("o_orderstatus"))}, "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'big' ELSE o_orderstatus END AS v FROM orders")
query("if_null_cond", "orders", {"o_orderkey": col("o_orderkey"), "v": when(op("gt", NULL, num(1)), num(1), col("o_orderkey"))}, "SELECT o_orderkey, o_orderkey::DOUBLE AS v FROM orders")
query("coalesce", "orders", {"o_orderkey": col("o_orderkey"), "v": coalesce(when(op("eq", col("o_orderstatus"), text("F")), NULL, col("o_orderstatus")), NULL, col("o_orderpriority"))}, "SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END, o_orderpriority) AS v FROM orders")
query("coalesce_empty", "region", {"r_name": col("r_name"), "v": coalesce()}, "SELECT r_name, NULL::VARCHAR AS v FROM region")

# Dates and casts.

_DAY = substring(cast(col("o_orderdate"), "string"), 0, 10)
_US = concat("/", substring(_DAY, 5, 2), substring(_DAY, 8, 2), substring(_DAY, 0, 4))
query("parse_date_iso", "orders", {"o_orderkey": col("o_orderkey"), "v": parse_date(_DAY, "%Y-%m-%d")}, "SELECT o_orderkey, o_orderdate::DATE AS v FROM orders")
query("parse_date_us", "orders", {"o_orderkey": col("o_orderkey"), "v": parse_date(_US, "%m/%d/%Y"), "w": parse_date(concat(" ", text("T"), _US), "T %m/%d/%Y")}, "SELECT o_orderkey, o_orderdate::DATE AS v, o_orderdate::DATE AS w FROM orders")
query("parse_date_short", "orders", {"o_orderkey": col("o_orderkey"), "v": parse_date(concat("", substring(_DAY, 2, 2), substring(_DAY, 5, 2), substring(_DAY, 8, 2)), "%y%m%d")}, "SELECT o_orderkey, o_orderdate::DATE AS v FROM orders")
query(
    "parse_date_bad",
    "orders",
    {"o_orderkey": col("o_orderkey"), "v": parse_date(concat("", _DAY, col("o_orderstatus")), "%Y-%m-%d"), "w": parse_date(text("2024-02-30"), "%Y-%m-%d"), "ok": parse_date(when(op("eq", col("o_orderstatus"), text("O")), _DAY, text("n/a")), "%Y-%m-%d")},
    "SELECT o_orderkey, NULL::DATE AS v, NULL::DATE AS w, CASE WHEN o_orderstatus = 'O' THEN o_orderdate::DATE END AS ok FROM orders",
)
query(
    "cast_int",
    "events",
    {"event_id": col("event_id"), "v": cast(col("value"), "int64"), "neg": cast(op("sub", num(0), col("value")), "int64"), "s": cast(col("event_type"), "int64"), "t": cast(cast(col("user_id"), "string"), "int64"), "b": cast(op("gt", col("value"), num(50)), "int64"), "d": cast(col("ts"), "int64")},
    "SELECT event_id, trunc(value)::BIGINT AS v, trunc(-value)::BIGINT AS neg, NULL::BIGINT AS s, user_id AS t, (value > 50)::BIGINT AS b, (ts::DATE - DATE '1970-01-01')::BIGINT AS d FROM events",
)
query("cast_float", "events", {"event_id": col("event_id"), "v": cast(col("user_id"), "float64"), "s": cast(concat(".", cast(col("user_id"), "string"), text("5")), "float64"), "bad": cast(text("5d"), "float64")}, "SELECT event_id, user_id::DOUBLE AS v, (user_id || '.5')::DOUBLE AS s, NULL::DOUBLE AS bad FROM events")
query("cast_string", "orders", {"o_orderkey": col("o_orderkey"), "v": cast(col("o_orderkey"), "string"), "d": cast(cast(col("o_orderdate"), "date"), "string"), "b": cast(op("gt", col("o_totalprice"), num(1000)), "string")}, "SELECT o_orderkey, o_orderkey::VARCHAR AS v, o_orderdate::DATE::VARCHAR AS d, (o_totalprice > 1000)::VARCHAR AS b FROM orders")
query(
    "cast_date",
    "orders",
    {"o_orderkey": col("o_orderkey"), "v": cast(_DAY, "date"), "n": cast(cast(cast(col("o_orderdate"), "date"), "int64"), "date"), "bad": cast(substring(_DAY, 0, 7), "date")},
    "SELECT o_orderkey, o_orderdate::DATE AS v, o_orderdate::DATE AS n, NULL::DATE AS bad FROM orders",
)

# Lookups.


def rows(*items: tuple[Any, ...]) -> list[Doc]:
    """Rows (patterns, output[, priority]) of a lookup."""
    return [{"input_patterns": i[0], "output": i[1]} | ({"priority": i[2]} if len(i) > 2 else {}) for i in items]


_FLAT = {"id": "kind", "case_insensitive": True, "rows": rows((["RING", "widget"], "SMALL"), (["gear"], "BIG"), (["small"], "SIZE"))}
_PRIORITY = {"id": "p", "case_insensitive": True, "rows": rows((["small"], "A"), (["ring"], "B", 10), (["red", "blue"], "C", 10), (["widget"], "D", -1))}
_TREE = {"id": "top", "case_insensitive": True, "rows": rows((["small", "red"], "PARENT", 100)), "catch_all": {"output": "REST"}, "children": [{"id": "kid", "case_insensitive": True, "rows": rows((["ring"], "KID")), "catch_all": {"output": "KIDREST"}, "children": [{"id": "grand", "rows": rows((["blue ring"], "GRAND"))}]}]}
_P = {"p_partkey": col("p_partkey")}
query("lookup_flat", "part", _P | {"v": lookup_ref("kind", col("p_name"))}, "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'ring') OR contains(lower(p_name), 'widget') THEN 'SMALL' WHEN contains(lower(p_name), 'gear') THEN 'BIG' WHEN contains(lower(p_name), 'small') THEN 'SIZE' END AS v FROM part", [_FLAT])
query("lookup_priority", "part", _P | {"v": lookup_ref("p", col("p_name"))}, "SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'B' WHEN contains(p_name, 'red') OR contains(p_name, 'blue') THEN 'C' WHEN contains(p_name, 'small') THEN 'A' WHEN contains(p_name, 'widget') THEN 'D' END AS v FROM part", [_PRIORITY])
_TREE_SQL = "CASE WHEN contains(p_name, 'blue ring') THEN 'GRAND' WHEN contains(p_name, 'ring') THEN 'KID' WHEN contains(p_name, 'small') OR contains(p_name, 'red') THEN 'PARENT' ELSE 'REST' END"
query("lookup_hier", "part", _P | {"v": lookup_ref("top", col("p_name"))}, f"SELECT p_partkey, {_TREE_SQL} AS v FROM part", [_TREE])
query("lookup_child_ref", "part", _P | {"v": lookup_ref("top.kid", col("p_name")), "g": lookup_ref("top.kid.grand", col("p_name"))}, "SELECT p_partkey, CASE WHEN contains(p_name, 'blue ring') THEN 'GRAND' WHEN contains(p_name, 'ring') THEN 'KID' ELSE 'KIDREST' END AS v, CASE WHEN contains(p_name, 'blue ring') THEN 'GRAND' END AS g FROM part", [_TREE])
query("lookup_catch_all", "events", {"event_id": col("event_id"), "v": lookup_ref("e", col("event_type"))}, "SELECT event_id, CASE WHEN contains(event_type, 'err') THEN 'BAD' WHEN contains(event_type, 'c') THEN 'C' ELSE 'OTHER' END AS v FROM events", [{"id": "e", "rows": rows((["err"], "BAD"), (["c"], "C")), "catch_all": {"output": "OTHER"}}])
query("lookup_case", "nation", {"n_name": col("n_name"), "v": lookup_ref("yes", col("n_name")), "w": lookup_ref("no", col("n_name"))}, "SELECT n_name, CASE WHEN contains(lower(n_name), 'a') THEN 'hit' END AS v, CASE WHEN contains(n_name, 'a') THEN 'hit' END AS w FROM nation", [{"id": "yes", "case_insensitive": True, "rows": rows((["A"], "hit"))}, {"id": "no", "rows": rows((["a"], "hit"))}])
query("lookup_null_input", "events", {"event_id": col("event_id"), "v": lookup_ref("e", when(op("gt", col("value"), num(50)), col("event_type"), NULL)), "all": lookup_ref("any", col("event_type"))}, "SELECT event_id, CASE WHEN value > 50 THEN CASE WHEN contains(event_type, 'view') THEN 'V' ELSE 'OTHER' END END AS v, 'EVERY' AS all FROM events", [{"id": "e", "rows": rows((["view"], "V")), "catch_all": {"output": "OTHER"}}, {"id": "any", "rows": rows(([""], "EVERY"))}])
# Some 500 patterns, of which many hit an input: the digits 0 to 499, ranked by 499 falling, over names that hold numbers.
_MANY = {"id": "many", "rows": rows(*(([f"{n:03d}"], f"out{n}", n % 7) for n in range(500))), "catch_all": {"output": "none"}}
query(
    "lookup_large",
    "customer",
    {"c_custkey": col("c_custkey"), "v": lookup_ref("many", col("c_name"))},
    "SELECT c_custkey, coalesce(out, 'none') AS v FROM customer LEFT JOIN (SELECT c_name AS name, arg_min('out' || n, (6 - n % 7) * 1000 + n) AS out FROM (SELECT DISTINCT c_name FROM customer), range(500) AS t(n) WHERE contains(c_name, lpad(n::VARCHAR, 3, '0')) GROUP BY c_name) ON c_name = name",
    [_MANY],
)
query("lookup_documents", "documents", {"doc_id": col("doc_id"), "v": lookup_ref("d", col("text"))}, "SELECT doc_id, CASE WHEN contains(lower(text), 'license') THEN 'LICENSED' WHEN contains(lower(text), ' the ') THEN 'EN' WHEN contains(lower(text), ' der ') THEN 'DE' ELSE 'OTHER' END AS v FROM documents", [{"id": "d", "case_insensitive": True, "rows": rows(([" THE "], "EN"), ([" der "], "DE"), (["License"], "LICENSED", 5)), "catch_all": {"output": "OTHER"}}])

# Union, assertions, partitions, jobs.


@registered("SELECT o_orderkey, o_totalprice AS v FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, o_custkey::DOUBLE AS v FROM orders WHERE o_orderstatus <> 'O'")
def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of rows whose column is a number in one and a whole number in the other."""
    orders = table(spark, sf_dir, "orders")
    open_ = mapped(orders.filter("o_orderstatus = 'O'"), {"o_orderkey": col("o_orderkey"), "v": col("o_totalprice")})
    rest = mapped(orders.filter("o_orderstatus <> 'O'"), {"o_orderkey": col("o_orderkey"), "v": col("o_custkey")})
    return union_all([open_, rest])


def asserted(name: str, source: str, columns: dict[str, Doc], schema: list[Doc], sql: str) -> None:
    """Register the violations of a table's assertions, a row for each."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wanted = model._value(model.AnalyticTable, {"id": "t", "name": "t", "output_prefix": "", "schema": schema}, "table")
        found = validate_assertions(mapped(table(spark, sf_dir, source), columns), wanted)
        return spark.createDataFrame([(v.column, v.kind, v.message) for v in found], "column string, kind string, message string")

    QUERIES[name] = run
    SQL[name] = sql


def rule(name: str, kind: str, **assertions: Any) -> Doc:
    return {"name": name, "type": kind, "assertions": assertions}


_FEW = when(op("gt", col("value"), num(100)), col("event_type"), NULL)
asserted("assert_not_null", "events", {"e": _FEW, "u": col("user_id")}, [rule("e", "string", not_null=True), rule("u", "int64", not_null=True)], "SELECT 'e' AS column, 'not_null' AS kind, (count(*) FILTER (WHERE NOT value > 100)) || ' null value(s) found' AS message FROM events HAVING count(*) FILTER (WHERE NOT value > 100) > 0")
asserted("assert_unique", "documents", {"text": col("text"), "doc_id": col("doc_id")}, [rule("text", "string", unique=True), rule("doc_id", "int64", unique=True)], "SELECT 'text' AS column, 'unique' AS kind, (count(text) - count(DISTINCT text)) || ' duplicate value(s)' AS message FROM documents HAVING count(text) > count(DISTINCT text)")
asserted("assert_accepted", "orders", {"s": col("o_orderstatus"), "k": col("o_custkey")}, [rule("s", "string", accepted_values=["O", "F", "F"]), rule("k", "int64", accepted_values=[])], "SELECT 's' AS column, 'accepted_values' AS kind, count(*) || ' value(s) not in accepted_values (3 allowed)' AS message FROM orders WHERE o_orderstatus NOT IN ('O', 'F') HAVING count(*) > 0")
asserted("assert_range", "orders", {"p": col("o_totalprice"), "d": cast(col("o_orderdate"), "date")}, [rule("p", "number", min=1000, max=400000.5), rule("d", "date", min=9500)], "SELECT 'p' AS column, 'range' AS kind, (count(*) FILTER (WHERE o_totalprice < 1000)) || ' below min, ' || (count(*) FILTER (WHERE o_totalprice > 400000.5)) || ' above max (min=Some(1000.0), max=Some(400000.5))' AS message FROM orders HAVING count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000.5) > 0 UNION ALL SELECT 'd', 'range', count(*) || ' below min, 0 above max (min=Some(9500.0), max=None)' FROM orders WHERE o_orderdate::DATE - DATE '1970-01-01' < 9500 HAVING count(*) > 0")
asserted("assert_multi", "lineitem", {"q": col("l_quantity"), "k": col("l_orderkey")}, [rule("gone", "string", not_null=True), rule("q", "number", unique=True, max=40), rule("k", "int64", not_null=True), {"name": "other", "type": "string"}], "SELECT 'gone' AS column, 'missing_column' AS kind, 'column not present in produced DataFrame' AS message UNION ALL SELECT 'q', 'unique', (count(*) - count(DISTINCT l_quantity)) || ' duplicate value(s)' FROM lineitem UNION ALL SELECT 'q', 'range', '0 below min, ' || count(*) || ' above max (min=None, max=Some(40.0))' FROM lineitem WHERE l_quantity > 40 HAVING count(*) > 0")


@registered("SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, count(*) AS n, min(o_orderdate::DATE) AS first FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL")
def partition_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with rows; null dates belong to none."""
    d = when(op("ne", col("o_orderstatus"), text("P")), cast(col("o_orderdate"), "date"), NULL)
    months = partition_by_month(mapped(table(spark, sf_dir, "orders"), {"d": d}), "d")
    return months.groupBy(F.col("year__").alias("year"), F.col("month__").alias("month")).agg(F.count("*").alias("n"), F.min("d").alias("first"))


def scratch(spark: SparkSession) -> str:
    """A new folder for one query's files: in the one that the cluster shares, or a temporary one on a single machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return f"{shared.rstrip('/')}/jobs/{uuid.uuid4().hex}"


ORDERS_CONFIG: Doc = {
    "version": 1,
    "source_containers": [{"id": "orders", "name": "Orders", "path_prefix": "raw/orders/", "schema": [{"name": "key", "type": "int64"}, {"name": "day", "type": "string"}, {"name": "status", "type": "string"}, {"name": "total", "type": "number"}]}],
    "lookup_mappings": [{"id": "state", "rows": rows((["F"], "FILLED"), (["O"], "OPEN")), "catch_all": {"output": "OTHER"}}],
    "mappings": [
        {
            "id": "by_month",
            "source_container_id": "orders",
            "analytic_table_id": "sales",
            "partition_by": {"column": "day", "granularity": "month"},
            "columns": [
                {"name": "key", "expr": col("key")},
                {"name": "day", "expr": parse_date(col("day"), "%Y-%m-%d")},
                {"name": "state", "expr": lookup_ref("state", col("status"))},
                {"name": "net", "expr": op("mul", col("total"), num(0.5))},
                {"name": "label", "expr": concat(":", unary("lower", col("status")), col("key"))},
            ],
        }
    ],
    "analytic_tables": [
        {
            "id": "sales",
            "name": "Sales",
            "output_prefix": "",
            "schema": [rule("key", "int64", not_null=True, unique=True), {"name": "day", "type": "date"}, rule("state", "string", accepted_values=["FILLED", "OPEN", "OTHER"]), rule("net", "number", min=0), {"name": "label", "type": "string"}],
        }
    ],
}
_SALES = "o_orderkey AS key, o_orderdate::DATE AS day, CASE WHEN contains(o_orderstatus, 'F') THEN 'FILLED' WHEN contains(o_orderstatus, 'O') THEN 'OPEN' ELSE 'OTHER' END AS state, o_totalprice * 0.5::DOUBLE AS net, lower(o_orderstatus) || ':' || o_orderkey AS label"


def orders_csv(spark: SparkSession, sf_dir: str, root: str, config: Doc) -> None:
    """The table orders as raw CSV files, one more file that is no CSV of its kind, and the config."""
    rows_ = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").cast("date").cast("string").alias("day"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"), F.lit("x").alias("extra"))
    rows_.repartition(3, "key").write.option("header", True).csv(f"{root}/raw/orders")
    objects = Objects(spark, root)
    objects.write("raw/orders/bad.csv", b"key,day\n1,2024-01-01\n")
    objects.write("pipeline.json", json.dumps(config).encode())


@registered(f"SELECT {_SALES}, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month FROM orders")
def pipeline_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV files to month-partitioned Parquet, twice over the same folder, read again."""
    root = scratch(spark)
    orders_csv(spark, sf_dir, root, ORDERS_CONFIG)
    for clean_run in (False, True):
        report = run_pipeline(spark, root, "", clean_run)
        if report.get("errors", True):
            raise RuntimeError(json.dumps(report))
    return spark.read.parquet(f"{root}/clean/sales")


@registered(f"SELECT {_SALES} FROM orders")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV files to one Parquet object, read again."""
    config = json.loads(json.dumps(ORDERS_CONFIG))
    del config["mappings"][0]["partition_by"]
    root = scratch(spark)
    orders_csv(spark, sf_dir, root, config)
    report = run_pipeline(spark, root, "")
    if report.get("errors", True):
        raise RuntimeError(json.dumps(report))
    return spark.read.parquet(f"{root}/clean/sales/by_month.parquet")


@registered(f"SELECT {_SALES} FROM orders WHERE o_orderkey % 3 = 0")
def csv_long_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a row that has more fields than the header, empty ones included, are left out whole; the others are read."""
    config = json.loads(json.dumps(ORDERS_CONFIG))
    del config["mappings"][0]["partition_by"]
    root = scratch(spark)
    parts = table(spark, sf_dir, "orders").withColumn("part", F.col("o_orderkey") % 3)
    for part, end in enumerate(("", ",", ",,x")):
        line = F.concat_ws(",", "o_orderkey", F.col("o_orderdate").cast("date"), "o_orderstatus", "o_totalprice")
        rows_ = parts.filter(F.col("part") == part).select(F.concat(line, F.lit(end)).alias("value"))
        rows_.coalesce(1).write.text(f"{root}/text{part}")
        objects = Objects(spark, root)
        (name,) = (k for k in objects.keys(f"text{part}/") if k.endswith(".txt"))
        objects.write(f"raw/orders/{part}.csv", b"key,day,status,total\n" + objects.read(name))
    objects.write("pipeline.json", json.dumps(config).encode())
    report = run_pipeline(spark, root, "")
    if report.get("errors", True):
        raise RuntimeError(json.dumps(report))
    return spark.read.parquet(f"{root}/clean/sales/by_month.parquet")


@registered("SELECT r_regionkey AS key, upper(r_name) AS name FROM region")
def first_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the option, a container's second mapping gives the columns of its first."""
    column = lambda name: {"name": name, "type": "string"}
    config = {
        "version": 1,
        "source_containers": [{"id": "r", "name": "R", "path_prefix": "raw/", "schema": [column("key"), column("name")]}],
        "lookup_mappings": [],
        "mappings": [
            {"id": "one", "source_container_id": "r", "analytic_table_id": "t", "columns": [{"name": "key", "expr": col("key")}, {"name": "name", "expr": unary("upper", col("name"))}]},
            {"id": "two", "source_container_id": "r", "analytic_table_id": "t", "columns": [{"name": "name", "expr": unary("lower", col("name"))}]},
        ],
        "analytic_tables": [{"id": "t", "name": "T", "output_prefix": "", "schema": [column("key"), column("name")]}],
    }
    root = scratch(spark)
    table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.lower("r_name").alias("name")).write.option("header", True).csv(f"{root}/raw")
    Objects(spark, root).write("pipeline.json", json.dumps(config).encode())
    report = run_pipeline(spark, root, "", options=Options(first_mapping=True))
    if report.get("errors", True):
        raise RuntimeError(json.dumps(report))
    found = spark.read.parquet(f"{root}/clean/t/two.parquet")
    return found.select(F.col("key").cast(table(spark, sf_dir, "region").schema["r_regionkey"].dataType), "name")


@registered("SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, count(*) - 1 AS in_order FROM orders GROUP BY ALL")
def month_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In each month's one file, rows whose date is not before that of the row before."""
    root = scratch(spark)
    orders_csv(spark, sf_dir, root, ORDERS_CONFIG)
    report = run_pipeline(spark, root, "")
    if report.get("errors", True):
        raise RuntimeError(json.dumps(report))
    rows_ = spark.read.option("basePath", f"{root}/clean/sales").parquet(f"{root}/clean/sales").select("year", "month", "day", F.col("_metadata.row_index").alias("at"))
    before = F.lag("day").over(Window.partitionBy("year", "month").orderBy("at"))
    return rows_.withColumn("before", before).groupBy("year", "month").agg(F.count_if(F.col("day") >= F.col("before")).alias("in_order"))


@registered("SELECT 'column `gone` missing_column: column not present in produced DataFrame' AS line UNION ALL SELECT 'column `q` range: 0 below min, ' || count(*) || ' above max (min=None, max=Some(40.0))' FROM lineitem WHERE l_quantity > 40 HAVING count(*) > 0")
def violation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations as the report lists them."""
    wanted = model._value(model.AnalyticTable, {"id": "t", "name": "t", "output_prefix": "", "schema": [rule("gone", "string", not_null=True), rule("q", "number", max=40)]}, "table")
    found = validate_assertions(mapped(table(spark, sf_dir, "lineitem"), {"q": col("l_quantity")}), wanted)
    return spark.createDataFrame([(str(v),) for v in found], "line string")


def _broken() -> Doc:
    """A config with one problem of each kind."""
    doc = json.loads(json.dumps(ORDERS_CONFIG))
    doc["source_containers"].append({"id": "orders", "name": "", "path_prefix": "", "schema": []})
    m = doc["mappings"][0]
    m["columns"][0]["expr"] = col("ghost")
    m["columns"][2]["expr"] = lookup_ref("state.none", col("status"))
    m["columns"].append({"name": "extra", "expr": NULL})
    m["partition_by"]["column"] = "state"
    doc["mappings"].append({"id": "", "source_container_id": "nowhere", "analytic_table_id": "nothing", "partition_by": {"column": "d", "granularity": "month"}, "columns": []})
    return doc


_PROBLEMS = (
    ("duplicate_id", "/source_containers/1/id", "duplicate source_container id `orders` at /source_containers/1/id"),
    ("missing_field", "/source_containers/1/name", "missing field `name` at /source_containers/1/name"),
    ("missing_field", "/mappings/1/id", "missing field `id` at /mappings/1/id"),
    ("dangling_reference", "/mappings/0/columns/2/expr", "dangling lookup reference to `state.none` at /mappings/0/columns/2/expr"),
    ("dangling_reference", "/mappings/0/columns/5/name", "dangling analytic_table_column reference to `sales.extra` at /mappings/0/columns/5/name"),
    ("schema", "/mappings/0/partition_by/column", "schema error at /mappings/0/partition_by/column: partition column `state` is type `string`; only `date` columns can be partitioned by month"),
    ("dangling_reference", "/mappings/0/columns/0/expr", "dangling source_column reference to `orders.ghost` at /mappings/0/columns/0/expr"),
    ("dangling_reference", "/mappings/1/source_container_id", "dangling source_container reference to `nowhere` at /mappings/1/source_container_id"),
    ("dangling_reference", "/mappings/1/analytic_table_id", "dangling analytic_table reference to `nothing` at /mappings/1/analytic_table_id"),
    ("dangling_reference", "/mappings/1/partition_by/column", "dangling mapping_output_column reference to `d` at /mappings/1/partition_by/column"),
)


@registered("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{k}', '{p}', '{m}')" for i, (k, p, m) in enumerate(_PROBLEMS)) + ") AS t(n, kind, path, message)")
def validate_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All problems of a broken config, in order; the unbroken one has none."""
    good = validate_config(ORDERS_CONFIG)
    found = [] if not good["ok"] else validate_config(_broken())["errors"]
    return spark.createDataFrame([(i, e["kind"], e["path"], e["message"]) for i, e in enumerate(found)], "n int, kind string, path string, message string")


@registered("SELECT o_orderkey, o_orderdate::DATE AS order_date, CASE WHEN contains(o_orderstatus, 'F') THEN 'FILLED' WHEN contains(o_orderstatus, 'O') THEN 'OPEN' ELSE 'OTHER' END AS status, o_totalprice * 1.1::DOUBLE AS total, lower(o_orderstatus) || '/' || o_orderpriority AS label FROM orders")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an analytic table: dates, lookups, arithmetic and text in one projection."""
    columns = {
        "o_orderkey": col("o_orderkey"),
        "order_date": parse_date(_DAY, "%Y-%m-%d"),
        "status": lookup_ref("state", col("o_orderstatus")),
        "total": op("mul", col("o_totalprice"), num(1.1)),
        "label": concat("/", unary("lower", col("o_orderstatus")), col("o_orderpriority")),
    }
    return mapped(table(spark, sf_dir, "orders"), columns, ORDERS_CONFIG["lookup_mappings"])
