"""A corpus pipeline: documents in, a training mixture out.

Each stage calls one operator of ``cohortlake.llm``, is written as Parquet to
the shared scratch folder and read back as the input of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.llm import decontaminate, mixing, near_dup, quality_classifier, secret_scan
from cohortlake.llm.common import free_name, stored, table

REJECT_BELOW = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.3 or more."""
    weights = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    names = docs.columns
    score = free_name(docs, "score")
    return quality_classifier.scored(docs, weights, score).where(F.col(score) >= REJECT_BELOW).select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five-word shingles, similarity of 0.8)."""
    return near_dup.drop_near_duplicates(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window of ten words."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark."""
    return secret_scan.redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn documents, a row for each draw, with shard, draw and slot."""
    return mixing.Mixture(docs).rows()


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("mixing", mixture),
]

#: The classifier and hashed draws have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
