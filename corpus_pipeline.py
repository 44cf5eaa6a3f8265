"""The corpus pipeline: documents in, a seeded and weighted training mix out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet to the shared scratch folder and reads again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarebird.llm import classifier, decontaminate, mixing, near_dup, pii
from rarebird.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality classifier scores 0.3 or more; learned from the labelled rows of ``docs``."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.filter_by_quality(docs, model, at_least=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of the smallest id, of each near-duplicate class."""
    return near_dup.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates; ``n_chars`` follows the new text."""
    replaced = pii.replace_pii(docs)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", F.when(F.col("text").isNotNull(), n_chars).otherwise(F.col("n_chars")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the weighted mix takes of each document it uses."""
    mixed = mixing.mix(docs, F.array("source"))
    return mixed.where("taken > 0").select("doc_id", F.get("sources", F.lit(0)).alias("source"), "size", "source_size", "target", "taken")


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
]

ORACLE_SQL = None  # a fitted model and an alignment are not SQL; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
