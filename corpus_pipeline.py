"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, source mix.

Each stage reads what the one before kept, as Parquet in the shared folder, so a lost executor costs no more than a
stage. All stages but the last return the columns of ``documents``; the last adds the copy number and the shuffle key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from benefacta.llm import dart, decontaminate, discriminant, ownership, poisson, queries
from benefacta.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant does not reject; it learns from the labels outside its held-out fold."""
    labels = queries.table(spark, sf_dir, "labels")
    return discriminant.accepted(docs, queries.quality_model(docs, labels, queries.remainder(5) != 0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return dart.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.remove_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that look live replaced in their texts."""
    return ownership.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target weights of their sources, in random order."""
    return poisson.replicate(docs)


STAGES = [
    ("quality_discriminant", quality),
    ("dart_minhash", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_ownership", secrets),
    ("poisson_mixing", mixing),
]

#: The classifier and the signatures have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
