"""What several tests need."""

from __future__ import annotations

import os

import duckdb


def against_sql(spark, query, sql, sf):
    """The query's rows equal those of the SQL over the same folder, whatever their order."""
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    got, want = query(spark, sf).toArrow(), con.sql(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    rows = lambda t: sorted(map(repr, zip(*[t.column(c).to_pylist() for c in sorted(got.column_names)], strict=True)))
    assert rows(got) == rows(want)
