"""From raw documents to packed training sequences: the stages, and the whole run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablerich.llm import exact, mixing, packing, quality, simhash
from tablerich.session import scratch_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with near fingerprints one stays."""
    return simhash.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the target weights of their sources take them."""
    return mixing.Mix(docs).documents()


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

#: The classifier is trained and packing is greedy: SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet in the shared folder, which the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
