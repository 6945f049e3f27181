"""Bounds of date columns from Parquet footers.

Spark's second data source interface answers MIN and MAX from the statistics of
the row groups; no row is read.  It is switched on in a session of its own, so
other plans keep the reader that they have.  It applies to whole relations:
a filter, or an expression below the aggregate, would read rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.plans.committed import Snapshot


def footer_session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def date_range_from_footers(held: Snapshot, columns: dict[str, str], layer: str | None = None) -> DataFrame:
    """(table_name, minimum_valid_date, maximum_valid_date) of the committed relations, by ``{relation: date column}``.

    A relation without rows has null bounds.
    """
    own = footer_session(held.store.spark)

    def one(relation: str, column: str) -> DataFrame:
        entries = [e for e in held.entries(layer) if e.relation == relation]
        if not any(e.rows for e in entries):
            return own.createDataFrame([(relation, None, None)], "table_name string, minimum_valid_date string, maximum_valid_date string")
        bounds = own.read.parquet(*[e.path for e in entries if e.rows]).agg(F.min(column).alias("low"), F.max(column).alias("high"))
        return bounds.select(F.lit(relation).alias("table_name"), F.col("low").cast("string").alias("minimum_valid_date"), F.col("high").cast("string").alias("maximum_valid_date"))

    return reduce(DataFrame.unionByName, [one(r, c) for r, c in columns.items()])
