"""Access to the driver's Parquet tables.

Only the columns an operator needs are selected, so the Parquet scan's
``ReadSchema`` stays narrow; filters written later reach ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    frame = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def event_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the tables that the event relations are made of, counted by the files' footers."""
    return sum(table(spark, sf_dir, name).count() for name in ("orders", "lineitem", "events"))
