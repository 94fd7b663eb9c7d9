"""A training-data pipeline: quality filter, near-duplicates, secrets, source mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import mixing, near_dedup, packing, secrets, subword
from gristmill.llm.common import fresh, save, shared_dir, table

#: Not expressible in SQL: a trained classifier comes first. Tested against plain versions of its stages instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = subword.fit(docs, table(spark, sf_dir, "labels"), "quality", 3, 1)
    (score,) = fresh(docs, "score")
    return subword.scored(docs, model, into=score).where(F.col(score) >= 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by five-word shingles at 0.8 or more."""
    return near_dedup.one_of_each(docs, shingle=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced and their length told anew."""
    (was,) = fresh(docs, "was")
    clean = secrets.redacted(docs.withColumn(was, F.col("text")))
    return clean.withColumn("n_chars", F.when(F.col("text").eqNullSafe(F.col(was)), F.col("n_chars")).otherwise(F.length("text").cast("long"))).drop(was)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take(docs, weights=(3, 1, 2), share=1.5, cap=2.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the words of each document go; the copies of one document never share a bin."""
    return packing.packed(docs, capacity=1024, cluster_col="doc_id")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = save(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return docs
