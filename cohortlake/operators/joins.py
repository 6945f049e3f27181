"""Join operators beyond the plain star join.

* ``aggregate_then_join``: each event frame is reduced to one row per key
  *before* it meets the base table (Catalyst does not push aggregates through
  a join by itself), so the join has fan-out 1.
* ``fan_out``: the size of the raw many-to-many join per key, computed from
  per-key counts instead of materialising every pair.
* ``join_one_to_one``: left join that fails inside the plan when a key repeats
  on either side, with a pandas-style match indicator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortlake.config import CONFIG

KEY = CONFIG.key


def aggregate_then_join(base: DataFrame, parts: list, key: str = KEY, how: str = "left") -> DataFrame:
    """``parts`` is a list of ``(frame, [agg Column, ...])``."""
    out = base
    for frame, aggs in parts:
        out = out.join(frame.groupBy(key).agg(*aggs), key, how)
    return out


def fan_out(left: DataFrame, right: DataFrame, key: str = KEY,
            left_name: str = "left_rows", right_name: str = "right_rows") -> DataFrame:
    """J4 without the pairs: rows the inner join ``left x right`` yields per key.

    Both sides are reduced to per-key counts (partial aggregation map-side);
    a key holding a third of all rows costs one counter, not n^2 output rows.
    """
    lc = left.groupBy(key).agg(F.count(F.lit(1)).alias(left_name))
    rc = right.groupBy(key).agg(F.count(F.lit(1)).alias(right_name))
    return lc.join(rc, key, "inner").withColumn("joined_rows", F.col(left_name) * F.col(right_name))


def _unique(frame: DataFrame, key: str, side: str) -> DataFrame:
    """Collapse to one row per key and raise (in-plan) if a key repeated."""
    others = [c for c in frame.columns if c != key]
    agg = [F.count(F.lit(1)).alias("_n")] + [F.any_value(c).alias(c) for c in others]
    checked = frame.groupBy(key).agg(*agg)
    # A filter (not a dropped column) so that column pruning cannot remove it.
    return checked.filter(
        F.when(F.col("_n") == 1, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"{side} key is not unique: "), F.col(key).cast("string")))
        )
    ).drop("_n")


def join_one_to_one(left: DataFrame, right: DataFrame, key: str = KEY,
                    indicator: str = "_merge") -> DataFrame:
    """Left join validated one-to-one, with indicator ``both`` / ``left_only``."""
    r = _unique(right, key, "right").withColumn("_matched", F.lit(True))
    out = _unique(left, key, "left").join(r, key, "left")
    ind: Column = F.when(F.col("_matched"), F.lit("both")).otherwise(F.lit("left_only"))
    return out.withColumn(indicator, ind).drop("_matched")


def stack_by_name(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
