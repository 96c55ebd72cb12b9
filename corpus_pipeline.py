"""From raw documents to token ids: quality, near-duplicates, benchmark passages, secrets, tokens.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents, whatever else these have, under whatever names.

Every stage takes null and empty texts (as texts without words), very long ones, rows without an id, rows that repeat or share an id,
and empty tables, which give empty results. What each does with them stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontaminate, quality, secrets, similar, simhash
from millrace.llm._ship import ship
from millrace.llm._store import stored
from millrace.llm.queries import documents, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. The model is fitted on the labelled rows of ``docs``.

    Each row is judged by its own text; equal texts share their verdict. Without labels of both classes all rows get one score, and
    without any all stay.
    """
    ship(spark)
    return quality.keep(docs, quality.fit(quality.featured(docs), table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (5-word shingles, similarity 0.8): the one with the smallest id, rows without an id last.

    Rows are compared one by one, so rows that share an id and nothing else all stay. Of equal ids the row with the least hash of
    its text stays, of rows equal in that too any one. Texts without words are near-duplicates of each other.
    """
    ship(spark)
    return simhash.keep_one(docs, unnamed=True, groups=similar.near_duplicates)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Each row is judged by its own text; without a benchmark all stay."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and n_chars counted anew; null texts stay null."""
    ship(spark)
    return secrets.redact(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the tokens of every document, in a row for each; null and empty texts have none."""
    ship(spark)
    return bpe.encode(docs, ["doc_id", "source"])


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each result written in the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can express neither the classifier nor the tokenizer; the tests hold run() against plain Python.
ORACLE_SQL = None
