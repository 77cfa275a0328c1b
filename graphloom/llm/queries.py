"""The registered queries of this subpackage: each derives its digest columns from an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm import decontaminate, html_text, media, near_dup, packing, quality, secrets, suffix_dedup, token_counts, token_files
from graphloom.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn=lambda doc_id: ~quality.held_out(doc_id))
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(quality.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place in its flat file and its count of ids without the end id."""
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "n_tokens", "at", "start")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048, end_id=1)


def op7_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every document and benchmark item that it holds part of."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = media.media_features(media.media_table(table(spark, sf_dir, "documents")))
    return features.withColumn("feature", F.lower(F.hex("phash"))).drop("phash")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.token_files(table(spark, sf_dir, "documents"), end_id=2)
    return files.select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_html_extraction, op3_secret_scan, op4_near_duplicates, op5_token_counts,
        op6_packing, op7_repeat_removal, op8_decontamination, op9_media_columns, op10_token_output,
    )
}

ORACLES = {"op3_secret_scan": secrets.oracle()}
