from __future__ import annotations

from pathlib import Path

import pytest

from millrace.llm import _store


def test_tables_are_kept_until_they_are_forgotten(spark):
    a, b = (_store.stored(spark.range(n).coalesce(1), "t") for n in (3, 4))
    assert (a.count(), b.count()) == (3, 4)
    places = [Path(df.inputFiles()[0].removeprefix("file://")).parent for df in (a, b)]
    _store.forget(a)
    assert [p.exists() for p in places] == [False, True]
    _store.clear(spark)
    assert not places[1].exists()
    assert _store._WRITTEN == []


def test_an_empty_table(spark):
    df = _store.stored(spark.createDataFrame([], "a int, b string"), "t")
    assert df.collect() == [] and df.columns == ["a", "b"]


def test_a_cluster_must_name_a_shared_folder(spark):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda name, default: default)})
        sparkContext = type("S", (), {"master": "local-cluster[3,2,1024]"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _store.shared_dir(Cluster)
    Cluster.conf = type("C", (), {"get": staticmethod(lambda name, default: "s3a://bucket/x/")})
    assert _store.shared_dir(Cluster) == "s3a://bucket/x"
