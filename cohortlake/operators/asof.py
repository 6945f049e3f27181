"""As-of windows, cohort reduction and mergeable partial aggregates.

* ``asof_window``: inclusive look-back filter; on a year/month partitioned
  layout it also adds the derived ``(year, month) IN (...)`` predicate, which
  Spark turns into ``PartitionFilters`` (it cannot derive it from the date).
* ``restrict_to_cohort``: left-semi join of an event or aggregate frame with
  the label keys, without hints.
* ``partial_*`` / ``merge_*``: per-day partial aggregates that merge into the
  windowed features (incremental refresh: only new days need new partials).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortlake.config import CONFIG
from cohortlake.functions.columns import date_window


def window_months(cutoff: str, days: int) -> list:
    """(year, month) pairs touched by the inclusive window ending at ``cutoff``."""
    end = dt.date.fromisoformat(cutoff)
    start = end - dt.timedelta(days=days - 1)
    months, y, m = [], start.year, start.month
    while (y, m) <= (end.year, end.month):
        months.append((y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return months


def asof_window(
    frame: DataFrame,
    date_col: str,
    cutoff: str,
    days: int,
    partition_cols: tuple | None = None,
) -> DataFrame:
    """rows with ``date_col`` in ``[cutoff - (days-1), cutoff]``.

    ``partition_cols=(year_col, month_col)`` adds the partition predicate.
    """
    pred = date_window(date_col, cutoff, days)
    if partition_cols:
        y, m = partition_cols
        codes = [yy * 100 + mm for yy, mm in window_months(cutoff, days)]
        pred = (F.col(y) * 100 + F.col(m)).isin(codes) & pred
    return frame.filter(pred)


def cohort_keys(labels: DataFrame, key: str = CONFIG.key) -> DataFrame:
    return labels.select(key)


def restrict_to_cohort(frame: DataFrame, labels: DataFrame, key: str = CONFIG.key) -> DataFrame:
    """Keep rows whose key is in the cohort (left semi join).

    No hint and no count: Spark broadcasts the keys only when their measured
    bytes allow it.  Give it per-key aggregates rather than raw events where
    the result is aggregated anyway: then a hot key is one row of the join.
    """
    return frame.join(cohort_keys(labels, key), key, "left_semi")


# --------------------------------------------------------------------------- per-cohort aggregates (A4, A5)
def transaction_aggregates(windowed: DataFrame, cutoff: str, key: str = CONFIG.key) -> DataFrame:
    """A4 over rows already cut to the window."""
    c = F.lit(cutoff).cast("date")
    return windowed.groupBy(key).agg(
        F.count(F.lit(1)).alias("transaction_count_90"),
        F.avg(F.col("is_auto_renew").cast("double")).alias("auto_renew_rate_90"),
        F.sum(F.when(F.col("is_cancel") == 1, 1).otherwise(0)).cast("long").alias("cancellation_count_90"),
        F.datediff(c, F.max("transaction_date")).alias("days_since_last_transaction"),
        F.datediff(F.max("membership_expire_date"), c).alias("days_until_expiration"),
    )


def active_days(date_col: str, cutoff: str, days: int) -> Column:
    """Aggregate: distinct days of the window that ends at ``cutoff``, one bit for each.

    The state is a long for every 64 days and merges by OR, so it is a plain hash
    aggregate with one shuffle; a distinct count shuffles by (key, day) first.
    Any number of rows a day is right, and days outside the window count for nothing.
    """
    back = F.datediff(F.lit(cutoff).cast("date"), F.col(date_col))
    words = []
    for first in range(0, days, 64):
        inside = back.between(first, min(first + 64, days) - 1)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), back - first)
        words.append(F.coalesce(F.bit_count(F.bit_or(F.when(inside, bit))), F.lit(0)))
    return reduce(lambda a, b: a + b, words).cast("long")


def listening_aggregates(windowed: DataFrame, cutoff: str, key: str = CONFIG.key, days: int = CONFIG.listening_days) -> DataFrame:
    """A5 over rows already cut to the window."""
    c = F.lit(cutoff).cast("date")
    return windowed.groupBy(key).agg(
        active_days("event_date", cutoff, days).alias("active_days_30"),
        F.sum("total_secs").alias("total_secs_30"),
        F.datediff(c, F.max("event_date")).alias("days_since_last_listen"),
    )


# --------------------------------------------------------------------------- mergeable partials
def daily_listening(logs: DataFrame, key: str = CONFIG.key) -> DataFrame:
    """One row per subscriber-day with the day's seconds."""
    return logs.groupBy(key, "event_date").agg(F.sum("total_secs").alias("total_secs"))


def partial_transactions(transactions: DataFrame, key: str = CONFIG.key) -> DataFrame:
    """A15 phase 1: per (key, transaction day) partial state.

    A day's partials never change once the day is closed, so they can be
    stored and only new days computed.
    """
    return transactions.groupBy(key, "transaction_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("is_auto_renew").cast("long")).alias("auto_renew_sum"),
        F.sum(F.when(F.col("is_cancel") == 1, 1).otherwise(0)).cast("long").alias("cancel_sum"),
        F.max("membership_expire_date").alias("latest_expiration"),
    )


def merge_transaction_partials(partials: DataFrame, cutoff: str, days: int = CONFIG.transaction_days,
                               key: str = CONFIG.key) -> DataFrame:
    """A15 phase 2: merge the partials of the window into A4's columns."""
    c = F.lit(cutoff).cast("date")
    merged = asof_window(partials, "transaction_date", cutoff, days).groupBy(key).agg(
        F.sum("n").alias("transaction_count_90"),
        F.sum("auto_renew_sum").alias("_renew"),
        F.sum("cancel_sum").alias("cancellation_count_90"),
        F.max("transaction_date").alias("_last"),
        F.max("latest_expiration").alias("_expire"),
    )
    return merged.select(
        key,
        "transaction_count_90",
        (F.col("_renew") / F.col("transaction_count_90")).alias("auto_renew_rate_90"),
        "cancellation_count_90",
        F.datediff(c, F.col("_last")).alias("days_since_last_transaction"),
        F.datediff(F.col("_expire"), c).alias("days_until_expiration"),
    )


def merge_listening_partials(daily: DataFrame, cutoff: str, days: int = CONFIG.listening_days,
                             key: str = CONFIG.key) -> DataFrame:
    """The days' bits merge by OR, so partials of a day may come in several rows."""
    c = F.lit(cutoff).cast("date")
    return asof_window(daily, "event_date", cutoff, days).groupBy(key).agg(
        active_days("event_date", cutoff, days).alias("active_days_30"),
        F.sum("total_secs").alias("total_secs_30"),
        F.datediff(c, F.max("event_date")).alias("days_since_last_listen"),
    )
