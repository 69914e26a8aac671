"""The corpus pipeline: toxicity, exact copies, near copies, benchmark passages, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
and read again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  SQL cannot express the toxicity model or the encoding, so the
pipeline is tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import content_sort, decontaminate, pieces, simhash, toxicity
from medallion.llm.common import store
from medallion.llm.queries import model_path, table

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return content_sort.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(docs, model_path()).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
