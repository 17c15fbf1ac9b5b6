"""Corpus pipeline: the stages that turn ``documents`` into a training mix.

Toxic documents go, repeated lines go (the first of each class stays), one document of each SimHash
class stays, documents that hold a benchmark item go, and sources are mixed to target weights.
Each stage works on all rows the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm.common import read, stored
from docloom.llm.decontamination import drop_leaked
from docloom.llm.line_dedup import drop_repeated_lines
from docloom.llm.mixing import mixed_documents
from docloom.llm.simhash import keep_one_of_each
from docloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaked(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL cannot express the stages (a learned grammar, edit joins, fingerprints); tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
