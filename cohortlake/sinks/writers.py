"""Sinks (S5-S13): Parquet, partitioned Parquet, CSV reports, gzip CSV, JSON.

Write layouts chosen for scale:

* partitioned tables use the ``REBALANCE`` hint on the partition columns:
  AQE splits a hot month into several tasks/files and merges small ones, so a
  month holding a third of the rows neither lands in one task nor produces a
  file per input partition;
* rows are sorted by the key inside each file, so Parquet min/max statistics
  prune on the key and a later partial aggregate per key compresses well;
* single-file writes (``coalesce(1)``) are used for small reports only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

CSV_TEXT_OPTIONS = {
    "header": True,
    # Keep padded keys such as '  ' as they are (the writer trims by default).
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_parquet(frame: DataFrame, path: str) -> str:
    """Overwrite an unpartitioned Parquet directory."""
    frame.write.mode("overwrite").parquet(path)
    return path


def with_year_month(frame: DataFrame, date_col: str, prefix: str) -> DataFrame:
    return frame.withColumn(f"{prefix}_year", F.year(date_col)).withColumn(f"{prefix}_month", F.month(date_col))


def month_layout(frame: DataFrame, date_col: str, prefix: str, key: str = "msno") -> tuple[DataFrame, tuple]:
    """Rows laid out for writing by derived ``{prefix}_year`` / ``{prefix}_month``, and these columns."""
    y, m = f"{prefix}_year", f"{prefix}_month"
    laid_out = (
        with_year_month(frame, date_col, prefix)
        .hint("rebalance", y, m)
        .sortWithinPartitions(y, m, key)
    )
    return laid_out, (y, m)


def write_partitioned_by_month(frame: DataFrame, path: str, date_col: str, prefix: str,
                               key: str = "msno") -> str:
    """Parquet partitioned by month."""
    laid_out, parts = month_layout(frame, date_col, prefix, key)
    laid_out.write.mode("overwrite").partitionBy(*parts).parquet(path)
    return path


def write_report_csv(frame: DataFrame, path: str) -> str:
    """One CSV file with header -- for small report frames only."""
    frame.coalesce(1).write.mode("overwrite").options(**CSV_TEXT_OPTIONS).csv(path)
    return path


def by_key_for_write(frame: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Cluster rows by ``key`` for writing, skew-safe.

    ``REBALANCE`` hash-partitions on the key (a subscriber's rows share a
    part file) but lets AQE split a partition that a hot key makes too large
    and merge small ones -- unlike ``repartition(n, key)``, which would put a
    key holding a third of all rows into one writer task.
    """
    return frame.hint("rebalance", partitions, key) if partitions else frame.hint("rebalance", key)


def write_gzip_csv(frame: DataFrame, path: str, partitions: int | None = None, key: str | None = "msno") -> str:
    """Gzip CSV, clustered by ``key`` when one is given."""
    out = by_key_for_write(frame, key, partitions) if key else frame
    out.write.mode("overwrite").options(**CSV_TEXT_OPTIONS).option("compression", "gzip").csv(path)
    return path


def write_json_lines(frame: DataFrame, path: str, field: str = "json") -> str:
    """Every row as one JSON document in a text file."""
    frame.select(F.to_json(F.struct(*frame.columns)).alias(field)).write.mode("overwrite").text(path)
    return path


def write_json(frame: DataFrame, path: str) -> str:
    """DataFrame to JSON lines (e.g. captured physical plans)."""
    frame.coalesce(1).write.mode("overwrite").json(path)
    return path


def show_and_write(frame: DataFrame, label: str, path: str, rows: int = 200) -> DataFrame:
    """Write a small report, then show what was written.

    Writing first and showing the written copy runs the report's plan once
    (showing first and writing after would run it twice without a cache).
    """
    write_report_csv(frame, path)
    written = frame.sparkSession.read.schema(frame.schema).option("header", True).csv(path)
    print(f"\n[MILESTONE] {label}")
    written.show(rows, truncate=False)
    return written
