"""A corpus cleaning pipeline of five operators, each stage written as Parquet and read again by the next.

quality -> near_duplicates -> repeated_passages -> decontamination -> packing. All stages but the last return the columns
of `documents`; the last returns the packed pieces of what the others have kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.llm import decontam, neardup, packing, passages, quality
from sieveworks.llm.common import materialise, table

#: Documents whose calibrated quality is below this are rejected.
LEAST_QUALITY = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all labels, does not reject."""
    return quality.keep(docs, table(spark, sf_dir, "labels"), F.lit(True), LEAST_QUALITY)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return neardup.keep_one(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long passages that an earlier document has too. What is left of a document stays, however short."""
    return passages.remove(docs, passages.repeats(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences."""
    return packing.pack(packing.pieces(docs, packing.vocabulary()))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", passage_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can express neither of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
