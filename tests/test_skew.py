"""Hot keys: one subscriber holds a third of all rows.

AQE's skew handling is forced on with tiny thresholds so that the skewed
partitions really are split at this size; the results must not change.
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import asof, features as feat

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    base = dt.date(2017, 1, 31)
    n = 3000
    ids = spark.range(n).select(
        # every third row belongs to the hot key "hot"; the rest spread over 500 keys
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("msno"),
        (F.col("id") % 2).cast("int").alias("is_auto_renew"),
        F.date_sub(F.lit(base), (F.col("id") % 80).cast("int")).alias("transaction_date"),
        F.date_add(F.lit(base), (F.col("id") % 40).cast("int")).alias("membership_expire_date"),
        (F.col("id") % 5 == 0).cast("int").alias("is_cancel"),
    )
    labels = spark.range(0, 500, 2).select(F.col("id").cast("string").alias("msno"), F.lit(0).alias("is_churn"))
    labels = labels.unionByName(spark.createDataFrame([("hot", 1)], "msno string, is_churn int"))
    yield ids, labels
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_semi_join_and_aggregates_survive_skew_split(spark, skewed):
    tx, labels = skewed
    windowed = asof.asof_window(tx, "transaction_date", "2017-01-31", 90)
    assert asof.restrict_to_cohort(windowed, labels).count() == windowed.join(labels.select("msno"), "msno").count()

    agg = lambda f: asof.transaction_aggregates(f, "2017-01-31")
    big = feat.cohort_aggregate(windowed, labels, agg)
    assert _rows(big) == _rows(agg(asof.restrict_to_cohort(windowed, labels)))
    hot = [r for r in big.collect() if r.msno == "hot"][0]
    assert hot.transaction_count_90 == 1000  # a third of the 3000 rows, all inside the window


def test_rebalanced_write_splits_hot_key_without_losing_rows(spark, skewed, tmp_path):
    from cohortlake.sinks.writers import write_gzip_csv

    tx, _ = skewed
    path = write_gzip_csv(tx.select("msno", "is_cancel"), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 3000 and back.filter("msno = 'hot'").count() == 1000


def test_aqe_marks_the_hot_key_join_as_skewed(spark, skewed):
    from cohortlake.plans.measure import physical_plan

    tx, labels = skewed
    joined = asof.restrict_to_cohort(tx, labels)
    joined.collect()  # the frame's own execution, so explain shows AQE's final plan
    plan = physical_plan(joined, "simple")
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
