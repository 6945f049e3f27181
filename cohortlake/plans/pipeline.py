"""Lazy end-to-end plans over the driver's tables: raw -> typed -> clean -> features.

These helpers only compose operators; each returns an unevaluated DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlake.config import CONFIG
from cohortlake.operators.features import build_cohort
from cohortlake.operators.quality import CleanTables, clean_all
from cohortlake.sources.fixtures import RawTables, raw_tables

COHORT_LABELS = {"february": "labels_february", "march": "labels_march"}


def raw(spark: SparkSession, sf_dir: str) -> RawTables:
    return raw_tables(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> CleanTables:
    return clean_all(raw_tables(spark, sf_dir))


def cohort_features(spark: SparkSession, sf_dir: str, cohort: str,
                    tables: CleanTables | None = None) -> DataFrame:
    t = tables or clean(spark, sf_dir)
    labels = getattr(t, COHORT_LABELS[cohort])
    return build_cohort(labels, t.members, t.transactions, t.user_logs, CONFIG.cutoffs[cohort])
