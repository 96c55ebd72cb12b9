from __future__ import annotations

import datetime as dt
import json
import threading
import urllib.request

import pytest

from millrace.errors import NoMapping, UnknownSourceContainer, UnsupportedGranularity
from millrace.plans import job, model
from millrace.plans.job import Options, resolve_mapping, run_pipeline
from millrace.service import REQUIRED, require_env, respond, server, store_settings
from millrace.sources.csv import ingest, missing_columns, resolve_container
from millrace.sources.objects import Objects
from millrace.sources.parquet import check_granularity, partition_key, unpartitioned_key


def config(**more):
    column = lambda name, kind: {"name": name, "type": kind}
    source = lambda name: {"kind": "col", "name": name}
    loans = {
        "id": "desk_loans",
        "source_container_id": "desk",
        "analytic_table_id": "loans",
        "partition_by": {"column": "day", "granularity": "month"},
        "columns": [
            {"name": "day", "expr": {"kind": "parse_date", "input": source("day"), "format": "%Y-%m-%d"}},
            {"name": "title", "expr": {"kind": "upper", "input": source("title")}},
            {"name": "fee", "expr": source("fee")},
        ],
    }
    doc = {
        "version": 1,
        "source_containers": [{"id": "desk", "name": "Front desk", "path_prefix": "raw/desk/", "schema": [column("day", "string"), column("title", "string"), column("fee", "number")]}],
        "lookup_mappings": [],
        "mappings": [loans],
        "analytic_tables": [{"id": "loans", "name": "Loans", "output_prefix": "", "schema": [column("day", "date"), column("title", "string"), column("fee", "number")]}],
    }
    return doc | more


FILES = {
    "spring.csv": "day,title,fee\n2023-03-30,atlas,0.5\n2023-04-09,herbal,3\n2023-04-02,field guide,1.25\n",
    "may.csv": "day,title,fee\n2023-05-11,ledger,2.75\n2023-05-12,primer,4.5\n",
    "late.csv": "day,title,fee\n2023-04-28,almanac,0.25\n",
}


@pytest.fixture
def root(tmp_path):
    def make(doc, files=FILES, at="p/"):
        base = tmp_path / at
        (base / "raw/desk").mkdir(parents=True, exist_ok=True)
        for name, data in files.items():
            (base / "raw/desk" / name).write_bytes(data.encode() if isinstance(data, str) else data)
        (base / "pipeline.json").write_text(doc if isinstance(doc, str) else json.dumps(doc))
        return tmp_path

    return make


def parquets(base):
    return sorted(str(p.relative_to(base)) for p in base.rglob("*.parquet"))


def test_end_to_end(spark, root):
    base = root(config())
    report = run_pipeline(spark, str(base), "p/")
    assert report["errors"] == []
    assert (report["partitions_written"], report["files_processed"]) == (3, 3)
    assert parquets(base) == [f"p/clean/loans/year=2023/month={m:02d}/desk_loans.parquet" for m in (3, 4, 5)]
    april = spark.read.parquet(str(base / "p/clean/loans/year=2023/month=04/desk_loans.parquet"))
    assert april.dtypes == [("day", "date"), ("title", "string"), ("fee", "double")]
    assert [tuple(r) for r in april.collect()] == [(dt.date(2023, 4, 2), "FIELD GUIDE", 1.25), (dt.date(2023, 4, 9), "HERBAL", 3.0), (dt.date(2023, 4, 28), "ALMANAC", 0.25)]


def test_a_second_run_replaces_and_clean_run_removes(spark, root):
    base = root(config())
    run_pipeline(spark, str(base), "p/")
    (base / "p/raw/desk/may.csv").unlink()
    root(config(), {"spring.csv": "day,title,fee\n2023-04-01,new,1.5\n"})
    run_pipeline(spark, str(base), "p/")
    april = "p/clean/loans/year=2023/month=04/desk_loans.parquet"
    assert len(parquets(base)) == 3  # March and May stay
    assert {r.title for r in spark.read.parquet(str(base / april)).collect()} == {"NEW", "ALMANAC"}
    run_pipeline(spark, str(base), "p/", clean_run=True)
    assert parquets(base) == [april]
    assert not list((base / "p/_staging").iterdir())


def test_clean_run_empties_tables_whatever_it_finds(spark, root):
    base = root(config())
    run_pipeline(spark, str(base), "p/")
    other = base / "p/clean/other/kept.parquet"
    other.parent.mkdir(parents=True)
    other.write_bytes(b"x")
    for f in (base / "p/raw/desk").iterdir():
        f.write_text("day\n")
    assert run_pipeline(spark, str(base), "p/", clean_run=True)["errors"] == ["ingest desk_loans: no files succeeded during ingestion"]
    assert parquets(base) == ["p/clean/other/kept.parquet"]
    root(config())
    run_pipeline(spark, str(base), "p/")
    for f in (base / "p/raw/desk").iterdir():
        f.unlink()
    assert run_pipeline(spark, str(base), "p/")["error"]["kind"] == "no_files" and len(parquets(base)) == 4
    assert run_pipeline(spark, str(base), "p/", clean_run=True)["error"]["kind"] == "no_files"
    assert parquets(base) == ["p/clean/other/kept.parquet"]  # of tables that the config has nothing is left


def test_bad_files_are_left_out(spark, root):
    more = {"bad.csv": "day,title\n2024-01-01,x\n", "long.csv": "day,title,fee\n2024-01-01,x,1,9\n", "empty.csv": "", "notes.txt": "day,title,fee\n2024-03-01,x,1\n", "none.csv": "day,title,fee\n"}
    base = root(config(), FILES | more)
    report = run_pipeline(spark, str(base), "p/")
    assert report["errors"] == []
    assert (report["partitions_written"], report["files_processed"]) == (3, 7)


def test_rows_with_more_fields_than_the_header_fail_their_file(spark, root):
    good = {"good.csv": 'a,b\n"1,1",2\n3\n4,\n"x ""y, z"" ",w\n', "quoted.csv": 'a,b\n"one\ntwo, three",4\n'}
    bad = {"empty.csv": "a,b\n1,2,\n3,4\n", "second.csv": "a,b\n3,4,,x\n", "third.csv": 'a,b\n"q, r",s,"t"\n', "last.csv": "a,b\n" + "1,2\n" * 999 + "1,2,3\n"}
    base = root(config(), good | bad)
    names = [f"p/raw/desk/{n}" for n in sorted(good | bad)]
    for multi_line in (True, False):
        if not multi_line:
            names.remove("p/raw/desk/quoted.csv")
        got = ingest(Objects(spark, str(base)), names, [model.ColumnSchema(n, "string") for n in "ab"], multi_line=multi_line)
        assert {k.rsplit("/", 1)[1] for k in got.failed} == set(bad)
        assert {str(e).split(":")[-1].strip() for e in got.failed.values()} == {"a row has more fields than the header"}
        found = sorted((r.a, r.b) for g in got.groups if g.keys == ["p/raw/desk/good.csv"] or "p/raw/desk/good.csv" in g.keys for r in g.frame.collect() if r.a != "one\ntwo, three")
        assert sorted(found, key=repr) == sorted([("1,1", "2"), ("3", None), ("4", None), ('x "y, z" ', "w")], key=repr)


def test_files_are_checked_once_for_all_mappings_of_a_container(spark, root, monkeypatch):
    calls = []
    monkeypatch.setattr(job, "ingest", lambda *args: calls.append(args[1]) or ingest(*args))
    doc = config()
    doc["mappings"].append(doc["mappings"][0] | {"id": "again"})
    assert run_pipeline(spark, str(root(doc)), "p/")["partitions_written"] == 6
    assert len(calls) == 1


def test_all_files_bad(spark, root):
    base = root(config(), {"bad.csv": "day\n2024-01-01\n"})
    assert run_pipeline(spark, str(base), "p/")["errors"] == ["ingest desk_loans: no files succeeded during ingestion"]


def test_broken_assertions_write_nothing(spark, root):
    doc = config()
    doc["analytic_tables"][0]["schema"][2]["assertions"] = {"max": 4}
    base = root(doc)
    report = run_pipeline(spark, str(base), "p/")
    assert report["errors"] == ["assertion desk_loans: column `fee` range: 0 below min, 1 above max (min=None, max=Some(4.0))"]
    assert parquets(base) == []


def test_null_dates_are_dropped_only_by_partitions(spark, root):
    files = {"a.csv": "day,title,fee\n2024-01-05,a,1\nnope,b,2\n"}
    base = root(config(), files)
    assert run_pipeline(spark, str(base), "p/")["partitions_written"] == 1
    doc = config()
    del doc["mappings"][0]["partition_by"]
    base = root(doc, files, at="q/")
    assert run_pipeline(spark, str(base), "q/")["partitions_written"] == 1
    assert spark.read.parquet(str(base / "q/clean/loans/desk_loans.parquet")).count() == 2


def test_an_empty_result_without_partitions_is_an_object(spark, root):
    doc = config()
    del doc["mappings"][0]["partition_by"]
    base = root(doc, {"a.csv": "day,title,fee\n"})
    assert run_pipeline(spark, str(base), "p/")["partitions_written"] == 1
    assert spark.read.parquet(str(base / "p/clean/loans/desk_loans.parquet")).count() == 0


def test_each_mapping_gets_its_own_columns_unless_told_otherwise(spark, root):
    doc = config()
    doc["mappings"].append({"id": "second", "source_container_id": "desk", "analytic_table_id": "loans", "columns": [{"name": "title", "expr": {"kind": "col", "name": "title"}}]})
    base = root(doc)
    report = run_pipeline(spark, str(base), "p/")
    assert report["partitions_written"] == 4
    assert spark.read.parquet(str(base / "p/clean/loans/second.parquet")).columns == ["title"]
    run_pipeline(spark, str(base), "p/", options=Options(first_mapping=True))
    assert spark.read.parquet(str(base / "p/clean/loans/second.parquet")).columns == ["day", "title", "fee"]


def test_reports_of_what_cannot_run(spark, root):
    base = root(config(), {})
    assert run_pipeline(spark, str(base), "p/")["error"] == {"kind": "no_files", "message": "No CSV files found to process", "details": []}
    assert run_pipeline(spark, str(base), "zzz/")["error"]["kind"] == "config_read_failed"
    assert run_pipeline(spark, str(root("not json")), "p/")["error"]["kind"] == "config_parse_failed"
    doc = config()
    doc["mappings"][0]["analytic_table_id"] = "gone"
    base = root(doc)
    assert run_pipeline(spark, str(base), "p/", options=Options(check_config=True))["error"]["kind"] == "config_invalid"
    assert run_pipeline(spark, str(base), "p/")["errors"] == ["table gone not found"]
    doc = config()
    doc["mappings"][0]["partition_by"]["granularity"] = "day"
    assert run_pipeline(spark, str(root(doc)), "p/")["errors"] == ['partition desk_loans: unsupported partition granularity: `day` (supported: "month")']


def test_types_are_inferred_by_file_and_widen(spark, root):
    schema = [model.ColumnSchema(n, "string") for n in ("b", "a", "n", "z")]
    base = root(config(), {"x.csv": "n,a,b,skip,z\n1,true,\"x,\n\"\"y\",9,\n-2,false,2024-01-05,,\n", "y.csv": "n,a,b,skip,z\n1.5,maybe,x,1,007\n", "z.csv": "b,z,a,n\n,,,\n"})
    got = ingest(Objects(spark, str(base)), [f"p/raw/desk/{n}.csv" for n in "xyz"], schema)
    assert not got.failed
    types = {tuple(g.keys): [t for _, t in g.frame.dtypes] for g in got.groups}
    assert types[("p/raw/desk/x.csv",)] == ["string", "boolean", "bigint", "bigint"]  # the last has no values: as in y.csv
    assert types[("p/raw/desk/y.csv",)] == ["string", "string", "double", "bigint"]
    x = next(g.frame for g in got.groups if g.keys == ["p/raw/desk/x.csv"])
    assert [tuple(r) for r in x.collect()] == [('x,\n"y', True, 1, None), ("2024-01-05", False, -2, None)]


def test_long_digits(spark, root):
    base = root(config(), {"x.csv": f"a,b\n{2**63 - 1},{2**63}\n", "y.csv": "a,b\n-5,1e400x\n"})
    got = ingest(Objects(spark, str(base)), [f"p/raw/desk/{n}.csv" for n in "xy"], [model.ColumnSchema(n, "number") for n in "ab"])
    assert [[t for _, t in g.frame.dtypes] for g in got.groups] == [["bigint", "double"], ["bigint", "string"]]
    assert got.groups[0].frame.first().a == 2**63 - 1


def test_names_that_differ_in_case_only(spark, root):
    base = root(config(), {"x.csv": "Amt,amt\n1,2\n"})
    got = ingest(Objects(spark, str(base)), ["p/raw/desk/x.csv"], [model.ColumnSchema("amt", "number")])
    assert [r.amt for r in got.groups[0].frame.collect()] == [2]


def test_names_of_files_with_spaces(spark, root):
    base = root(config(), {"a b%20é.csv": "day,title,fee\n2024-01-05,a,1\n"})
    assert run_pipeline(spark, str(base), "p/")["partitions_written"] == 1


def test_large_months_can_be_split(spark, root):
    rows_ = "".join(f"2024-01-{1 + i % 28:02d},d{i},{i}\n" for i in range(2000))
    base = root(config(), {"a.csv": "day,title,fee\n" + rows_ + "nope,x,1\n"})
    options = Options(split_months=True, multi_line=False)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        report = run_pipeline(spark, str(base), "p/", options=options)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert report["errors"] == [] and report["partitions_written"] > 1
    month = base / "p/clean/loans/year=2024/month=01"
    assert len(list(month.glob("desk_loans*.parquet"))) == report["partitions_written"]
    assert spark.read.parquet(str(month)).distinct().count() == 2000
    run_pipeline(spark, str(base), "p/")
    assert [p.name for p in month.glob("*.parquet")] == ["desk_loans.parquet"]


def test_assertions_see_rows_without_a_date(spark, root):
    doc = config()
    doc["analytic_tables"][0]["schema"][0]["assertions"] = {"not_null": True}
    base = root(doc, {"a.csv": "day,title,fee\n2024-01-05,a,1\nnope,b,2\n"})
    assert run_pipeline(spark, str(base), "p/")["errors"] == ["assertion desk_loans: column `day` not_null: 1 null value(s) found"]
    assert parquets(base) == []


def test_small_parts():
    schema = [model.ColumnSchema(n, "string") for n in "ab"]
    assert missing_columns(["A", "b", "c"], schema) == ["a"]
    containers = [model.SourceContainer(i, i, p, []) for i, p in (("one", "raw/"), ("two", "raw/x/"))]
    assert resolve_container("raw/x/1.csv", containers).id == "one"
    with pytest.raises(UnknownSourceContainer):
        resolve_container("other/1.csv", containers)
    with pytest.raises(NoMapping):
        resolve_mapping("nowhere", model.parse_config(config()))
    with pytest.raises(UnsupportedGranularity):
        check_granularity(model.PartitionBy("d", "day"))
    assert partition_key("t", "m", 2024, 3) == "clean/t/year=2024/month=03/m.parquet"
    assert unpartitioned_key("t", "m") == "clean/t/m.parquet"


def test_service(spark, root):
    base = root(config())
    assert respond("GET", "/health", b"", None, None) == (200, "ok")
    assert respond("POST", "/config/validate", json.dumps(config()).encode(), None, None) == (200, {"ok": True})
    assert respond("POST", "/config/validate", b"not json", None, None)[1]["errors"][0]["kind"] == "schema"
    assert respond("POST", "/jobs/run", b'{"pipeline_prefix": "p/"}', None, None)[0] == 500
    assert respond("POST", "/jobs/run", b"{}", spark, str(base))[0] == 400
    assert respond("POST", "/jobs/run", b'{"pipeline_prefix": "no/"}', spark, str(base))[0] == 400
    for options in ('{"nope": 1}', '{"multi_line": "no"}', '{"typing": "guess"}', "[]"):
        assert respond("POST", "/jobs/run", f'{{"pipeline_prefix": "p/", "options": {options}}}'.encode(), spark, str(base))[0] == 400
    body = b'{"pipeline_prefix": "p/", "options": {"typing": "declared", "multi_line": false, "check_config": true}}'
    assert respond("POST", "/jobs/run", body, spark, str(base))[1]["partitions_written"] == 3
    status, report = respond("POST", "/jobs/run", b'{"pipeline_prefix": "p/"}', spark, str(base))
    assert (status, report["partitions_written"], set(report)) == (200, 3, {"job_id", "partitions_written", "files_processed", "errors"})
    http = server(None, None, 0)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    try:
        assert urllib.request.urlopen(f"http://127.0.0.1:{http.server_port}/health").read() == b"ok"
    finally:
        http.shutdown()


def test_objects_behind_another_scheme(spark, root):
    """A mount under viewfs:// stands in for an object store: nothing there has a local path."""
    base = root(config())
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.bucket.link./data", f"file://{base}")
    report = run_pipeline(spark, "viewfs://bucket/data", "p/")
    assert (report["errors"], report["partitions_written"]) == ([], 3)
    (base / "p/raw/desk/spring.csv").write_text("day,title,fee\n2023-04-01,new,1.5\n")
    assert run_pipeline(spark, "viewfs://bucket/data", "p/", clean_run=True)["partitions_written"] == 2
    found = Objects(spark, "viewfs://bucket/data")
    assert found.keys("p/clean/") == [f"p/clean/loans/year=2023/month={m:02d}/desk_loans.parquet" for m in (4, 5)]
    assert {r.title for r in spark.read.parquet(found.uri("p/clean/loans/year=2023/month=04/desk_loans.parquet")).collect()} == {"NEW", "ALMANAC"}


def test_settings_of_the_object_store():
    found = store_settings(dict.fromkeys(REQUIRED, "x") | {"AWS_ENDPOINT_URL": "http://store:9000", "AWS_REGION": "here"})
    assert found["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000" and found["spark.hadoop.fs.s3a.endpoint.region"] == "here"
    assert found["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert set(found) == {f"spark.hadoop.fs.s3a.{k}" for k in ("endpoint", "endpoint.region", "access.key", "secret.key", "path.style.access")}


def test_environment():
    require_env(dict.fromkeys(REQUIRED, "x"))
    with pytest.raises(RuntimeError, match="S3_BUCKET, AWS_REGION"):
        require_env(dict.fromkeys(REQUIRED, "x") | {"S3_BUCKET": "", "AWS_REGION": ""})


def test_stream(spark, root, tmp_path):
    from millrace.operators.lookup import build_registry
    from millrace.streaming.mapping import map_stream, read_stream, write_stream

    base = root(config())
    c = model.parse_config(config())
    rows = read_stream(spark, str(base / "p/raw/desk"), c.source_containers[0])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: write_stream(map_stream(rows, c.mappings[0], build_registry([])), c.analytic_tables[0], out, state).trigger(availableNow=True).start().awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 6
    (base / "p/raw/desk/march.csv").write_text("day,title,fee\n2024-03-01,x,1\n")
    run()
    assert spark.read.parquet(out).count() == 7
