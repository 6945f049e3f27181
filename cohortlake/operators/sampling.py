"""Deterministic hash sampling and splitting (F5-F7, E3 helpers).

A subscriber's bucket depends on its key only, so samples are stable across
file layouts, partition counts and reruns (unlike ``sample``/``randomSplit``),
and the samples for growing percentages are nested prefixes of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortlake.config import CONFIG
from cohortlake.functions.columns import hash_bucket

KEY = CONFIG.key


def hash_sample(frame: DataFrame, percent: int, key: str = KEY, modulus: int = CONFIG.bucket_modulus) -> DataFrame:
    """keep the keys whose bucket is below ``percent`` (of ``modulus``)."""
    return frame.filter(hash_bucket(key, modulus) < percent)


def hash_split(frame: DataFrame, train_buckets: int = CONFIG.train_buckets, key: str = KEY,
               bucket_col: str = "split_bucket"):
    """(train, validation) = buckets below / at-or-above ``train_buckets``.

    A NULL key has a NULL bucket and falls out of both sides.
    """
    b = frame.withColumn(bucket_col, hash_bucket(key))
    return b.filter(F.col(bucket_col) < train_buckets), b.filter(F.col(bucket_col) >= train_buckets)


def sample_tier(key: str = KEY, percentages=CONFIG.scaling_percentages) -> Column:
    """Smallest percentage whose sample holds the key (NULL when in none).

    The sample for ``p`` is exactly the rows with ``tier <= p``; storing the
    tier lets every percentage be written once and read by partition pruning.
    """
    b = hash_bucket(key)
    expr = None
    for p in sorted(percentages):
        expr = F.when(b < p, F.lit(p)) if expr is None else expr.when(b < p, F.lit(p))
    return expr


def nested_counts(frame: DataFrame, tier_col: str, percentages=CONFIG.scaling_percentages,
                  name: str = "rows") -> DataFrame:
    """Row count of every nested sample in one pass: (percentage, name)."""
    wide = frame.agg(*[F.count_if(F.col(tier_col) <= p).alias(str(p)) for p in percentages])
    long = wide.unpivot([], [str(p) for p in percentages], "percentage", name)
    return long.select(F.col("percentage").cast("int").alias("percentage"), F.col(name).cast("long").alias(name))
