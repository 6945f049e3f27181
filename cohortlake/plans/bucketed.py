"""Feature inputs stored by buckets of the key: a star join without any exchange.

Labels, members, and the day partials of both event tables are written with
``bucketBy(n, key).sortBy(key)``.  All four have the same buckets, so the window
aggregates and the join of the four read each bucket where it lies: no shuffle
between the scans and the features, at any cutoff.

Bucketed are rows per key or per key and day, not raw events, so a hot subscriber
is at most a row a day in its bucket.  Rows are rebalanced by bucket before the write,
where AQE splits a bucket that is too large into several files.

The files belong to a committed store; a table of the session's catalog is only
the view that tells Spark of the buckets, made when the store is opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.config import CONFIG
from cohortlake.operators import asof
from cohortlake.operators.features import feature_join
from cohortlake.plans.committed import Store

KEY = CONFIG.key
RELATIONS = ("labels_february", "labels_march", "members", "tx_daily", "log_daily")


@dataclass(frozen=True)
class BucketedStore:
    base: str
    buckets: int = 64

    @property
    def layer(self) -> str:
        return f"bucketed_{self.buckets}"

    def write(self, spark: SparkSession, frames: dict[str, DataFrame]) -> None:
        """Frames of one row per key, or per key and day, as one commit."""
        store = Store(spark, self.base)
        store.commit([store.write(name, self._dealt(frame), self.layer, bucket_by=(self.buckets, KEY)) for name, frame in frames.items()])

    def _dealt(self, frame: DataFrame) -> DataFrame:
        # The number of a key's bucket is Spark's hash of it, so a task of the rebalance writes whole buckets or parts of one.
        bucket = "__bucket"
        return frame.withColumn(bucket, F.pmod(F.hash(KEY), F.lit(self.buckets))).hint("rebalance", bucket).drop(bucket)

    def read(self, spark: SparkSession, relation: str) -> DataFrame:
        return Store(spark, self.base).latest().read_bucketed(relation, self.layer, self.buckets, KEY)


def write_inputs(spark: SparkSession, store: BucketedStore, labels_february: DataFrame, labels_march: DataFrame,
                 members: DataFrame, transactions: DataFrame, user_logs: DataFrame) -> BucketedStore:
    """The clean tables as bucketed feature inputs; events are summed to day partials first."""
    store.write(spark, {
        "labels_february": labels_february, "labels_march": labels_march, "members": members,
        "tx_daily": asof.partial_transactions(transactions), "log_daily": asof.daily_listening(user_logs),
    })
    return store


def bucketed_features(spark: SparkSession, store: BucketedStore, cohort: str, cutoff: str | None = None,
                      tx_days: int = CONFIG.transaction_days, log_days: int = CONFIG.listening_days) -> DataFrame:
    """B5 of a cohort, read bucket by bucket."""
    cutoff = cutoff or CONFIG.cutoffs[cohort]
    membership = store.read(spark, "members").select(
        KEY, F.datediff(F.lit(cutoff).cast("date"), F.col("registration_date")).alias("membership_tenure_days"))
    tx = asof.merge_transaction_partials(store.read(spark, "tx_daily"), cutoff, tx_days)
    logs = asof.merge_listening_partials(store.read(spark, "log_daily"), cutoff, log_days)
    return feature_join(store.read(spark, f"labels_{cohort}"), membership, tx, logs)
