"""The operators of this subpackage as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, decontaminate, fingerprints, pii, quality, secrets, simhash, substring, toxicity
from millrace.llm._ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; from here on workers have this package too."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A table in fewer pieces than this is small enough to be dealt out to more cores.
FEW = 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table documents. A small one in fewer pieces than there are cores is dealt out once, for all cores to work on.

    The pieces are how the rows are laid out and change no result. Rows are dealt by id and text, so those without an id spread too.
    """
    docs = table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() >= min(cores, FEW):
        return docs
    return docs.repartition(cores, F.xxhash64("doc_id", "text"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(documents(spark, sf_dir))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(documents(spark, sf_dir))


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op1 that SQL can express."""
    return secrets.counts(documents(spark, sf_dir))


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op3 that SQL can express."""
    return pii.counts(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_quality, op3_pii, op4_fingerprints, op5_decontaminate, op6_bpe, op7_toxicity, op8_substrings, op9_chat, op10_simhash, secret_counts, pii_counts)}

ORACLE_SQL = {"op5_decontaminate": decontaminate.ORACLE, "op8_substrings": substring.ORACLE, "op9_chat": chat.ORACLE, "secret_counts": secrets.COUNTS, "pii_counts": pii.COUNTS}
