"""The corpus pipeline: toxicity, exact dedup, near dedup, personal data, packing.

Each stage works on all rows its predecessor kept, and its decisions take effect: rejected, repeated and near-equal documents go, personal
data is replaced. Between stages the documents are written as Parquet and read again, so that a lost executor repeats tasks of one
stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionkit.llm import exact, near, packing, pii, toxicity
from decisionkit.llm.common import read, scratch_path
from decisionkit.llm.queries import vocabulary


def acceptable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's toxicity threshold."""
    return toxicity.keep_acceptable(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.keep_distinct(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return near.keep_one_of_each(docs, width=5, share=80)


def anonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the text."""
    out = pii.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and where each stands in the packed sequences."""
    return packing.packed(docs, vocabulary("word"))


STAGES = [
    ("toxicity", acceptable),
    ("exact_dedup", distinct),
    ("near_dedup", dissimilar),
    ("personal_data", anonymous),
    ("packing", sequences),
]

#: SQL cannot express the classifier, the tokeniser and the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
