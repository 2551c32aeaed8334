"""Corpus preparation: documents in, the training mix out.

Quality rules drop bad texts, near-duplicates are reduced to one document of each group, documents
that hold benchmark items go, personal data is masked, and what is left is mixed to the target
weights of its sources.  Each stage takes (spark, docs, sf_dir), with ``docs`` read from Parquet,
and returns all rows it keeps; all but the last return the columns of ``docs``, the last also the
number of the copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regalign.llm.common import materialize, read_table
from regalign.llm.decontaminate import decontaminate
from regalign.llm.mixing import mixed
from regalign.llm.pii import sanitise
from regalign.llm.quality_rules import good_documents
from regalign.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sanitise(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

#: Learned rules, connected components and Newton steps have no SQL form; the tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
