"""From raw documents to a training mix: every stage reads what the one before it kept.

Toxic documents go, then exact copies, near copies and documents that hold benchmark passages; what is left is mixed to
target weights by source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from martloom.llm.text import documents, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier doesn't flag, by the threshold of their language."""
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.filter(~F.col("flagged")).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, A-Z lower-cased, the one with the largest id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near fingerprints, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
]

ORACLE_SQL = None  # a trained classifier and XXH64 fingerprints are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
