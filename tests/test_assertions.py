from __future__ import annotations

import pytest

from millrace.operators.assertions import _bound, validate_assertions
from millrace.plans import model


def check(spark, rows, kind, parity=False, **rules):
    df = spark.createDataFrame([(x,) for x in rows], f"a {kind}")
    table = model._value(model.AnalyticTable, {"id": "t", "name": "t", "output_prefix": "", "schema": [{"name": "a", "type": "string", "assertions": rules}]}, "t")
    return [(v.kind, v.message) for v in validate_assertions(df, table, parity)]


@pytest.mark.parametrize(
    ("rows", "kind", "rules", "want"),
    [
        ([1, 2, 3], "int", {}, []),
        ([1, None, 3], "long", {"not_null": True}, [("not_null", "1 null value(s) found")]),
        ([1, None], "long", {"not_null": False}, []),
        ([1, 2, 2, 3], "long", {"unique": True}, [("unique", "1 duplicate value(s)")]),
        ([None, None, 1], "long", {"unique": True}, []),
        (["FOOD", "TRAVEL", "UNKNOWN", None], "string", {"accepted_values": ["FOOD", "TRAVEL"]}, [("accepted_values", "1 value(s) not in accepted_values (2 allowed)")]),
        (["FOOD"], "string", {"accepted_values": []}, []),
        ([0.0, 5.0, 11.0, float("nan"), None], "double", {"min": 1, "max": 10}, [("range", "1 below min, 1 above max (min=Some(1.0), max=Some(10.0))")]),
        ([1, 1, 100], "long", {"unique": True, "max": 50}, [("unique", "1 duplicate value(s)"), ("range", "0 below min, 1 above max (min=None, max=Some(50.0))")]),
        (["5", "x", "50"], "string", {"max": 10}, [("range", "0 below min, 1 above max (min=None, max=Some(10.0))")]),
        ([], "long", {"not_null": True, "unique": True, "min": 1}, []),
        ([0], "int", {"min": 5, "max": -5}, [("range", "1 below min, 0 above max (min=Some(5.0), max=Some(-5.0))")]),
    ],
)
def test_cases(spark, rows, kind, rules, want):
    assert check(spark, rows, kind, **rules) == want


def test_a_null_hides_a_duplicate_only_if_asked_for(spark):
    assert check(spark, [1, 1, None], "long", unique=True) == [("unique", "1 duplicate value(s)")]
    assert check(spark, [1, 1, None], "long", parity=True, unique=True) == []


def test_missing_column(spark):
    df = spark.createDataFrame([(1,)], "b int")
    table = model._value(model.AnalyticTable, {"id": "t", "name": "t", "output_prefix": "", "schema": [{"name": "a", "type": "string", "assertions": {"not_null": True}}, {"name": "c", "type": "string"}]}, "t")
    (v,) = validate_assertions(df, table)
    assert str(v) == "column `a` missing_column: column not present in produced DataFrame"


def test_bounds_are_written_plainly():
    assert [_bound(x) for x in (None, 1, 0.5, 1e16, 1e-7)] == ["None", "Some(1.0)", "Some(0.5)", "Some(1e16)", "Some(1e-7)"]


def held(spark, run):
    """What ``run`` gives, and the most MB that one of its tasks held for sorts and aggregations."""
    sc = spark.sparkContext
    sc.setJobGroup("held", "held")
    out = run()
    sc.setJobGroup("", "")
    jsc = sc._jsc.sc()
    jsc.listenerBus().waitUntilEmpty()
    tracker, most = sc.statusTracker(), 0
    for job in tracker.getJobIdsForGroup("held"):
        for stage in tracker.getJobInfo(job).stageIds:
            tasks = jsc.statusStore().taskList(stage, 0, 1000)
            found = [tasks.apply(i).taskMetrics() for i in range(tasks.size())]
            most = max([most, *(m.get().peakExecutionMemory() for m in found if m.isDefined())])
    return out, most / 1e6


def test_one_task_holds_no_more_the_more_distinct_values_there_are(spark):
    df = spark.range(3_000_000, numPartitions=1).selectExpr("id % 2999999 AS a")
    table = model._value(model.AnalyticTable, {"id": "t", "name": "t", "output_prefix": "", "schema": [{"name": "a", "type": "int64", "assertions": {"unique": True}}]}, "t")
    found, most = held(spark, lambda: validate_assertions(df, table))
    assert [v.message for v in found] == ["1 duplicate value(s)"]
    assert most < 250


@pytest.mark.parametrize(
    ("rows", "kind"),
    [
        ([*range(300), 7, 7, None, None], "long"),
        ([*(x / 4 for x in range(300)), 0.0, -0.0, float("nan"), float("nan"), -float("nan"), None], "double"),
        ([*(f"é{x}" * 20 for x in range(300)), "", "", "é3" * 20, None], "string"),
        ([True, False, True, None], "boolean"),
        ([None, None], "string"),
        ([], "long"),
    ],
)
@pytest.mark.parametrize("parity", [False, True])
def test_distinct_values_are_the_same_however_they_are_dealt(spark, monkeypatch, rows, kind, parity):
    whole = check(spark, rows, kind, parity, unique=True)
    monkeypatch.setattr("millrace.operators.assertions.HELD", 1000)
    assert check(spark, rows, kind, parity, unique=True) == whole
    distinct = len({"nan" if x != x else x for x in rows if x is not None}) + (parity and None in rows)
    extra = sum(x is not None for x in rows) - distinct
    assert whole == ([("unique", f"{extra} duplicate value(s)")] if extra > 0 else [])
