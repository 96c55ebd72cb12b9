from __future__ import annotations

import datetime as dt
import math

import pytest

from millrace.errors import EvalError, UnknownLookup
from millrace.functions.dates import date_format
from millrace.functions.expr import project
from millrace.plans.model import parse_node
from millrace.queries import NULL, cast, coalesce, col, concat, contains, lookup_ref, num, op, parse_date, substring, text, unary, when


def run(spark, expr, rows=((0,),), schema="i int"):
    df = spark.createDataFrame(list(rows), schema)
    return [r.v for r in project(df, {"v": parse_node(expr)}).collect()]


def same(a, b):
    return a == b and math.copysign(1, a) == math.copysign(1, b) or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_division_of_doubles_is_ieee(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, -0.0), (6.0, 4.0), (None, 0.0), (float("nan"), 0.0), (float("inf"), 0.0)]
    got = run(spark, op("div", col("a"), col("b")), rows, "a double, b double")
    want = [math.inf, -math.inf, math.nan, -math.inf, 1.5, None, math.nan, math.inf]
    assert all(x is y is None or same(x, y) for x, y in zip(got, want, strict=True))


def test_whole_numbers(spark):
    rows = [(7, 2), (-7, 2), (7, 0), (-(2**63), -1), (None, 1)]
    assert run(spark, op("div", col("a"), col("b")), rows, "a long, b long") == [3, -3, None, None, None]
    assert run(spark, op("add", col("a"), col("b")), [(2**63 - 1, 1), (1, 2)], "a long, b long") == [None, 3]
    assert run(spark, op("mul", col("a"), num(2)), [(3,)], "a int") == [6.0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_results_do_not_depend_on_ansi_mode(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert run(spark, op("div", col("a"), num(0)), [(1,)], "a long") == [math.inf]
        assert run(spark, op("sub", col("a"), col("a")), [(1,)], "a long") == [0]
        assert run(spark, cast(col("s"), "int64"), [("x",), ("12",), (" 12 ",), ("12.5",), ("",), ("9" * 30,)], "s string") == [None, 12, None, None, None, None]
        assert run(spark, cast(col("s"), "float64"), [("1e3",), ("5d",), (" 5",), (".5",), ("-2.",)], "s string") == [1000.0, None, None, 0.5, -2.0]
        assert run(spark, cast(col("x"), "int64"), [(-2.7,), (float("nan"),), (1e30,)], "x double") == [-2, None, None]
        assert run(spark, cast(col("s"), "date"), [("2024-02-30",), ("2024",), ("2024-02-29",)], "s string") == [None, None, dt.date(2024, 2, 29)]
        assert run(spark, cast(col("n"), "date"), [(0,), (19000,), (2**40,)], "n long") == [dt.date(1970, 1, 1), dt.date(2022, 1, 8), None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_text(spark):
    rows = [("FROM", "ACCT"), ("FROM", None), (None, None)]
    assert run(spark, concat(" ", col("a"), col("b")), rows, "a string, b string") == ["FROM ACCT", "FROM", ""]
    assert run(spark, op("add", col("a"), col("b")), rows, "a string, b string") == ["FROMACCT", None, None]
    assert run(spark, unary("trim", col("a")), [(" \t é b  \n",)], "a string") == ["é b"]
    assert run(spark, substring(col("a"), -5, 3), [("abc",)], "a string") == ["a"]
    assert run(spark, substring(col("a"), 1), [("äbc",), (None,)], "a string") == ["bc", None]
    assert run(spark, contains(col("a"), col("b")), [("a.c", "."), ("abc", "."), ("x", ""), (None, "x")], "a string, b string") == [True, False, True, None]


def test_choices(spark):
    rows = [("HIT", "FALLBACK"), (None, "FALLBACK"), (None, None)]
    assert run(spark, coalesce(col("a"), col("b")), rows, "a string, b string") == ["HIT", "FALLBACK", None]
    assert run(spark, coalesce(col("a"), NULL), [(None,)], "a string") == [None]
    assert run(spark, coalesce()) == [None]
    assert run(spark, when(NULL, num(1), num(2))) == [2.0]
    assert run(spark, when(op("gt", col("i"), num(-1)), col("i"), num(2.5))) == [0.0]
    assert run(spark, when(op("gt", col("i"), num(-1)), col("i"), text("x"))) == ["0"]


def test_nan_compares_as_the_largest(spark):
    rows = [(float("nan"), float("nan")), (float("nan"), 1.0), (1.0, None)]
    assert run(spark, op("eq", col("a"), col("b")), rows, "a double, b double") == [True, False, None]
    assert run(spark, op("gt", col("a"), col("b")), rows, "a double, b double") == [False, True, None]


@pytest.mark.parametrize(
    "expr",
    [
        op("eq", col("s"), num(1)),
        op("mul", col("s"), num(1)),
        op("add", col("s"), num(1)),
        unary("upper", num(1)),
        contains(num(1), text("x")),
        concat(","),
        col("nope"),
        when(num(1), num(1), num(2)),
        substring(col("s"), 0, -1),
        parse_date(col("s"), "%Q"),
    ],
)
def test_what_does_not_fit_is_an_error_before_any_row_is_read(spark, expr):
    with pytest.raises(EvalError):
        run(spark, expr, [("x",)], "s string")


def test_unknown_lookup(spark):
    with pytest.raises(UnknownLookup, match="unknown lookup id: nope"):
        run(spark, lookup_ref("nope", text("x")))


def test_names_that_differ_in_case_only(spark):
    df = spark.createDataFrame([(1, 2)], "c1 long, C1 long")
    assert [tuple(r) for r in project(df, {"a": parse_node(col("c1")), "b": parse_node(col("C1"))}).collect()] == [(1, 2)]


def test_a_constant_has_a_row_for_each_row(spark):
    assert run(spark, text("x"), [(1,), (2,), (3,)]) == ["x"] * 3


@pytest.mark.parametrize(
    ("fmt", "text_", "want"),
    [
        ("%Y-%m-%d", "2024-01-01", dt.date(2024, 1, 1)),
        ("%Y-%m-%d", "not-a-date", None),
        ("%Y-%m-%d", "2024-01-01x", None),
        ("%m/%d/%Y", "1/5/2024", dt.date(2024, 1, 5)),
        ("%Y%m%d", "20240105", dt.date(2024, 1, 5)),
        ("%d-%b-%y", "05-Jan-75", dt.date(1975, 1, 5)),
        ("%d %B %Y", "5 january 2024", dt.date(2024, 1, 5)),
        ("%F", "2024-01-05", dt.date(2024, 1, 5)),
        ("%D", "01/05/69", dt.date(2069, 1, 5)),
        ("%a %d %b %Y", "Fri 05 Jan 2024", dt.date(2024, 1, 5)),
        ("%A, %d.%m.%Y", "Friday, 05.01.2024", dt.date(2024, 1, 5)),
        ("%Y-%j", "2024-060", dt.date(2024, 2, 29)),
        ("%Y-%m-%dT%H:%M:%S", "2024-01-05T10:11:12", dt.date(2024, 1, 5)),
        ("on %Y's %m-%d", "on 2024's 01-05", dt.date(2024, 1, 5)),
        ("100%% %Y-%m-%d", "100% 2024-01-05", dt.date(2024, 1, 5)),
    ],
)
def test_dates(spark, fmt, text_, want):
    assert run(spark, parse_date(col("s"), fmt), [(text_,)], "s string") == [want]


def test_date_patterns():
    assert date_format("%Y%m%d").pattern == "yyyyMMdd"
    assert date_format("%m/%d/%Y").pattern == "M/d/yyyy"
