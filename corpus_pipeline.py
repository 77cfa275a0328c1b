"""The corpus pipeline: quality, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads; all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm import decontaminate, near_dup, packing, quality, secrets
from graphloom.llm.common import table, written

#: A document goes if label 1 is the less likely.
REJECT_BELOW = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn=lambda doc_id: ~quality.held_out(doc_id))
    return quality.keep_good(docs, model, REJECT_BELOW)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold part of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars follows."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into sequences of at most 2048 ids."""
    return packing.pack(docs, capacity=2048, end_id=1)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scan", secret_stage),
    ("packing", packing_stage),
]

#: A trained network and sampled hashes have no SQL; tests/llm/ holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
