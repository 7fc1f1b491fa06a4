"""Documents to token ids in five stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.llm import decontamination, near_duplicates, personal_data, pieces, quality
from tillmark.llm.common import read, stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or score below the threshold."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked documents."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents and cuts benchmark passages out of the others."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by its kind."""
    return personal_data.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality rules", good_documents),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("sentencepiece", encoded),
]

# The language model of the quality stage and the boosted trees cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
