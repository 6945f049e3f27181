"""Row-level reconciliation of two tables as multisets of rows (V1).

Both tables are first reduced to an order-free digest for each range of the key's
hash (rows and sum of row hashes, combined in every task: as many rows as ranges
are shuffled, whatever the tables' size).  Ranges with equal digests hold the same
rows.  Only rows of the ranges that differ go on, are counted per distinct row,
and those with other counts are returned.  Equal tables cost one aggregate each.

Rows compare exactly, nulls equal to nulls; a double that was summed in another
order is another value, so round such columns first.  A row that stands more often
on one side counts by the difference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlake.plans.committed import content

RANGES = 4096


def _range(key: str, ranges: int):
    return F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")


def differing_ranges(left: DataFrame, right: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """(range, rows_left, rows_right) of the key ranges whose contents differ."""
    columns = left.columns

    def digests(frame: DataFrame, side: str) -> DataFrame:
        found = frame.select(*columns).groupBy(_range(key, ranges).alias("range")).agg(*content(columns))
        return found.select("range", F.col("rows").alias(f"rows_{side}"), F.col("digest").alias(f"digest_{side}"))

    both = digests(left, "left").join(digests(right, "right"), "range", "full_outer")
    unlike = ~F.col("rows_left").eqNullSafe(F.col("rows_right")) | ~F.col("digest_left").eqNullSafe(F.col("digest_right"))
    return both.where(unlike).select("range", F.coalesce("rows_left", F.lit(0)).alias("rows_left"), F.coalesce("rows_right", F.lit(0)).alias("rows_right"))


def row_differences(left: DataFrame, right: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """The rows that do not stand equally often in both tables, with ``only_left`` and ``only_right`` (copies).

    The numbers of the ranges that differ (at most ``ranges``) are collected when
    the plan is built; where there are none, no table is read again.
    """
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    columns = left.columns
    found = [r[0] for r in differing_ranges(left, right, key, ranges).select("range").collect()]
    if not found:
        none = left.limit(0).withColumns({"only_left": F.lit(0).cast("long"), "only_right": F.lit(0).cast("long")})
        return none

    def rows(frame: DataFrame, side: int) -> DataFrame:
        return frame.select(*columns).where(_range(key, ranges).isin(found)).withColumn("__side", F.lit(side))

    excess = F.sum("__side")
    counted = rows(left, 1).unionByName(rows(right, -1)).groupBy(*columns).agg(excess.alias("__excess")).where("__excess <> 0")
    over = F.col("__excess")
    return counted.select(*columns, F.greatest(over, F.lit(0)).alias("only_left"), F.greatest(-over, F.lit(0)).alias("only_right"))


def key_differences(left: DataFrame, right: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """(key, only_left, only_right): per key, the copies of rows that stand on one side only."""
    found = row_differences(left, right, key, ranges)
    return found.groupBy(key).agg(F.sum("only_left").alias("only_left"), F.sum("only_right").alias("only_right"))
