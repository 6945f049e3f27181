"""One-row-per-subscriber feature tables as of a cutoff date.

Plan shape of ``build_cohort`` (checked with ``explain``):

* each event table is cut to its inclusive window (filter reaches the Parquet
  scan; on the partitioned layout also the partition filter);
* the events are aggregated first (partial aggregate map-side, one shuffle on
  the key) and the cohort join drops other keys, whatever the cohort's size;
* the label table is then left-joined to three one-row-per-key frames that are
  all hash-partitioned on the key: no fan-out, one exchange per side.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, functions as F

from cohortlake.config import CONFIG
from cohortlake.functions.columns import (
    absent_flag,
    engagement_group,
    is_valid_key,
    renewal_group,
)
from cohortlake.operators import asof
from cohortlake.operators.asof import asof_window, listening_aggregates, transaction_aggregates

KEY = CONFIG.key


def cohort_aggregate(events: DataFrame, labels: DataFrame, aggregate: Callable[[DataFrame], DataFrame],
                     key: str = KEY, restrict: bool = True) -> DataFrame:
    """Aggregate ``events`` per key, then keep the cohort's keys (J3 + A4/A5).

    Raw rows only meet in the map-side aggregation, so a hot key costs one row
    a task; the semi join reuses the aggregate's partitioning.
    """
    out = aggregate(events)
    return asof.restrict_to_cohort(out, labels, key) if restrict else out


def membership_features(labels: DataFrame, members: DataFrame, cutoff: str, key: str = KEY) -> DataFrame:
    """Tenure in days at the cutoff for every label row (NULL if unknown)."""
    return labels.select(key).join(members, key, "left").select(
        key,
        F.datediff(F.lit(cutoff).cast("date"), F.col("registration_date")).alias("membership_tenure_days"),
    )


def member_tenure(typed_members: DataFrame, cutoff: str, key: str = CONFIG.key) -> DataFrame:
    """Days from the latest known registration of each valid key to the cutoff."""
    days = F.datediff(F.lit(cutoff).cast("date"), F.max("registration_date"))
    return typed_members.filter(is_valid_key(key)).groupBy(key).agg(days.alias("membership_tenure_days"))


def transaction_features(
    transactions: DataFrame,
    labels: DataFrame,
    cutoff: str,
    days: int = CONFIG.transaction_days,
    partition_cols: tuple | None = None,
    restrict: bool = True,
) -> DataFrame:
    """B2: count, auto-renew rate, cancellations, recency, days to expiry."""
    windowed = asof_window(transactions, "transaction_date", cutoff, days, partition_cols)
    return cohort_aggregate(windowed, labels, lambda f: transaction_aggregates(f, cutoff), restrict=restrict)


def listening_features(
    user_logs: DataFrame,
    labels: DataFrame,
    cutoff: str,
    days: int = CONFIG.listening_days,
    partition_cols: tuple | None = None,
    restrict: bool = True,
) -> DataFrame:
    """Active days, seconds, recency over the listening window."""
    windowed = asof_window(user_logs, "event_date", cutoff, days, partition_cols)
    return cohort_aggregate(windowed, labels, lambda f: listening_aggregates(f, cutoff, days=days), restrict=restrict)


def feature_join(labels: DataFrame, membership: DataFrame, tx: DataFrame, listening: DataFrame,
                 key: str = KEY) -> DataFrame:
    """Label-preserving star join with the absence rules.

    Absent partners give 0 counts/rates/seconds, NULL recency and tenure, and
    explicit 0/1 absence flags.
    """
    t = tx.withColumn("_t", F.lit(1))
    g = listening.withColumn("_g", F.lit(1))
    j = labels.join(membership, key, "left").join(t, key, "left").join(g, key, "left")
    return j.select(
        key,
        F.col("is_churn").cast("int").alias("is_churn"),
        "membership_tenure_days",
        F.coalesce("transaction_count_90", F.lit(0).cast("long")).alias("transaction_count_90"),
        F.coalesce("auto_renew_rate_90", F.lit(0.0)).alias("auto_renew_rate_90"),
        F.coalesce("cancellation_count_90", F.lit(0).cast("long")).alias("cancellation_count_90"),
        "days_since_last_transaction",
        "days_until_expiration",
        absent_flag("_t").alias("no_recent_transaction"),
        F.coalesce("active_days_30", F.lit(0).cast("long")).alias("active_days_30"),
        F.coalesce("total_secs_30", F.lit(0.0)).alias("total_secs_30"),
        "days_since_last_listen",
        absent_flag("_g").alias("no_recent_listening"),
    )


def build_cohort(
    labels: DataFrame,
    members: DataFrame,
    transactions: DataFrame,
    user_logs: DataFrame,
    cutoff: str,
    tx_days: int = CONFIG.transaction_days,
    log_days: int = CONFIG.listening_days,
    tx_partitions: tuple | None = None,
    log_partitions: tuple | None = None,
) -> DataFrame:
    """The whole feature table of one cohort (labels, cutoff).

    The final left joins from the labels already drop non-cohort keys, so the
    large-cohort path needs no extra semi join.
    """
    # members hold one row per key, so tenure is computed before the join.
    membership = members.select(
        KEY,
        F.datediff(F.lit(cutoff).cast("date"), F.col("registration_date")).alias("membership_tenure_days"),
    )
    tx = transaction_features(transactions, labels, cutoff, tx_days, tx_partitions, restrict=False)
    lg = listening_features(user_logs, labels, cutoff, log_days, log_partitions, restrict=False)
    return feature_join(labels, membership, tx, lg)


# --------------------------------------------------------------------------- segments
def churn_segments(features: DataFrame) -> DataFrame:
    """Churn by engagement x renewal group, highest churn rate first."""
    return (
        features.groupBy(
            engagement_group().alias("engagement_group"),
            renewal_group().alias("renewal_group"),
        )
        .agg(
            F.count(F.lit(1)).alias("subscribers"),
            F.sum("is_churn").cast("long").alias("churners"),
            F.avg(F.col("is_churn").cast("double")).alias("churn_rate"),
        )
        .orderBy(F.desc("churn_rate"), F.desc("subscribers"))
    )


# --------------------------------------------------------------------------- checks
def grain_check(cohort: str, cutoff: str, features: DataFrame, labels: DataFrame, key: str = KEY) -> DataFrame:
    """G1: rows = distinct keys = label rows, else the query fails.

    The failure is raised inside the plan (``raise_error``) when the row is
    computed; no driver round trip is needed.
    """
    label_rows = labels.select(F.count(F.lit(1))).scalar()
    s = features.agg(
        F.count(F.lit(1)).alias("feature_rows"),
        F.count_distinct(key).alias("distinct_feature_users"),
        F.coalesce(F.sum("is_churn"), F.lit(0)).cast("long").alias("churners"),
    )
    passed = (F.col("feature_rows") == F.col("label_rows")) & (F.col("distinct_feature_users") == F.col("label_rows"))
    return s.select(
        F.lit(cohort).alias("cohort"),
        F.lit(cutoff).alias("feature_cutoff"),
        label_rows.alias("label_rows"),
        "feature_rows",
        "distinct_feature_users",
        "churners",
    ).withColumn(
        "grain_check_passed",
        F.when(passed, F.lit(True)).otherwise(
            F.raise_error(F.lit(f"{cohort} feature-table grain check failed"))
        ),
    )


def feature_null_summary(cohort: str, features: DataFrame,
                         columns: tuple = CONFIG.feature_columns) -> DataFrame:
    """NULL count of every feature in one pass, unpivoted to rows."""
    wide = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "null_rows").select(
        F.lit(cohort).alias("cohort"), "feature", F.col("null_rows").cast("long").alias("null_rows")
    )


def feature_checksum(features: DataFrame, key: str = KEY) -> DataFrame:
    """A10: control totals of a feature table."""
    return features.agg(
        F.count(F.lit(1)).alias("output_rows"),
        F.count_distinct(key).alias("distinct_users"),
        F.coalesce(F.sum("transaction_count_90"), F.lit(0)).cast("long").alias("transaction_count_checksum"),
        F.coalesce(F.sum("active_days_30"), F.lit(0)).cast("long").alias("active_days_checksum"),
        F.coalesce(F.sum("total_secs_30"), F.lit(0.0)).alias("listening_seconds_checksum"),
    )
