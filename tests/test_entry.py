from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from millrace import queries as engine
from tests_support import against_sql

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(engine.QUERIES))
def test_query_matches_its_sql(spark, name):
    against_sql(spark, engine.QUERIES[name], engine.SQL[name], SF)


def test_division_matches_its_sql_on_odd_rows(spark, tmp_path):
    """No price and no sign of zero changes what a zero discount gives; other discounts divide."""
    odd = "[NULL, 0.0, -0.0, 1.5, -1.5, 'inf', '-inf', 'nan', 1e308, 5e-324]::DOUBLE[]"
    pairs = f"SELECT unnest({odd}) AS l_extendedprice, l_discount FROM (SELECT unnest({odd}) AS l_discount)"
    duckdb.sql(f"COPY (SELECT row_number() OVER () AS l_orderkey, 1::INTEGER AS l_linenumber, * FROM ({pairs})) TO '{tmp_path}/lineitem.parquet'")
    assert engine.QUERIES["div_zero"](spark, str(tmp_path)).count() == 100
    against_sql(spark, engine.QUERIES["div_zero"], engine.SQL["div_zero"], str(tmp_path))


def test_entry(spark):
    assert entry.entry(spark).count() == 1500


def test_every_query_of_the_engine_has_sql():
    assert set(engine.QUERIES) == set(engine.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_engine_works_without_the_subpackage_for_training_data():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("millrace.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "col_project" in e.queries() and "pipeline" not in e.queries() and not any(k.startswith("op1") for k in e.queries())
assert set(e.oracle_sql()) == set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "millrace").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path
