"""Tables written once in the folder that all executors share, to cut lineage without keeping blocks on executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: A temporary folder for each application of one machine.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where that is unset a temporary folder serves on one machine; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="millrace-")
        found = _LOCAL[context.applicationId]
    return found.rstrip("/")


#: What this process has written and not forgotten.
_WRITTEN: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lost executors cost nothing that came before."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files that a stored table was read from, once nothing reads it any more."""
    _delete(df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()})


def clear(spark: SparkSession) -> None:
    """Delete all stored tables of this process; results that still read them must have been written or collected."""
    _delete(spark, set(_WRITTEN))


def _delete(spark: SparkSession, paths: set[str]) -> None:
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    names = {p.rsplit("/", 1)[1] for p in paths}
    _WRITTEN[:] = [w for w in _WRITTEN if w.rsplit("/", 1)[1] not in names]
