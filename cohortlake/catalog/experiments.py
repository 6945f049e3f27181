"""Strategy experiments and the scaling samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlake import oracle as O
from cohortlake.catalog.io import curated_stage, raw_csv_stage, scaling_stage
from cohortlake.config import CONFIG
from cohortlake.operators.reconcile import reconcile
from cohortlake.plans import curate, experiments as X, pipeline
from cohortlake.registry import register

FEB = CONFIG.cutoffs["february"]
PCTS = CONFIG.scaling_percentages
PCT_VALUES = ", ".join(f"({p})" for p in PCTS)


@register("exp_join_strategy", """
WITH pairs AS (SELECT g.msno, COUNT(*) AS n FROM feb_join_logs g JOIN feb_join_tx t ON g.msno = t.msno GROUP BY g.msno),
     s AS (SELECT (SELECT COUNT(*) FROM labels_february) AS users, (SELECT COUNT(*) FROM feb_join_logs) AS logs,
                  (SELECT COUNT(*) FROM feb_join_tx) AS tx,
                  (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM pairs) AS raw_rows,
                  (SELECT COUNT(*) FROM feb_aggregate_first) AS agg_rows)
SELECT 'raw_many_to_many_join' AS strategy, users AS sample_subscribers, logs AS input_listening_rows,
       tx AS input_transaction_rows, raw_rows AS output_rows,
       raw_rows / GREATEST(users, 1) AS output_rows_per_subscriber FROM s
UNION ALL
SELECT 'aggregate_before_join', users, logs, tx, agg_rows, agg_rows / GREATEST(users, 1) FROM s""",
          doubles=("output_rows_per_subscriber",))
def exp_join_strategy(spark, sf):
    return X.join_strategy(pipeline.clean(spark, sf))


@register("exp_csv_vs_parquet", f"""
WITH c AS (SELECT NULLIF(msno, '') AS msno, CAST(try_strptime(date, '%Y%m%d') AS DATE) AS event_date, total_secs
           FROM raw_user_logs),
     ca AS (SELECT msno, COUNT(DISTINCT event_date) AS d, SUM(total_secs) AS s FROM c
            WHERE event_date BETWEEN DATE '{FEB}' - 29 AND DATE '{FEB}' AND total_secs >= 0 GROUP BY msno),
     pa AS (SELECT msno, COUNT(DISTINCT event_date) AS d, SUM(total_secs) AS s FROM user_logs
            WHERE event_date BETWEEN DATE '{FEB}' - 29 AND DATE '{FEB}' GROUP BY msno),
     b AS (SELECT 'CSV' AS format, COUNT(*) AS output_users, COALESCE(SUM(s), 0.0) AS seconds_checksum FROM ca
           UNION ALL
           SELECT 'Parquet', COUNT(*), COALESCE(SUM(s), 0.0) FROM pa)
SELECT format, output_users, seconds_checksum,
       (SELECT MIN(output_users) = MAX(output_users) AND ABS(MAX(seconds_checksum) - MIN(seconds_checksum)) < 0.01 FROM b)
         AS results_match
FROM b""", doubles=("seconds_checksum",))
def exp_csv_vs_parquet(spark, sf):
    cur = curated_stage(spark, sf)
    csv_logs = f"{raw_csv_stage(spark, sf)}/user_logs"
    return X.format_experiment(spark, None, cur.user_logs, csv_logs, partition_cols=curate.LOG_PARTITIONS)


def _sample_counts_sql() -> str:
    return f"""
WITH p(percentage) AS (VALUES {PCT_VALUES}),
     tx AS (SELECT t.msno FROM transactions t WHERE t.transaction_date BETWEEN DATE '{FEB}' - 89 AND DATE '{FEB}'),
     dl AS (SELECT msno, event_date FROM user_logs WHERE event_date BETWEEN DATE '{FEB}' - 29 AND DATE '{FEB}'
            GROUP BY msno, event_date)
SELECT CAST(p.percentage AS INTEGER) AS percentage,
       (SELECT COUNT(*) FROM feb_bucketed b WHERE b.bucket < p.percentage) AS label_rows,
       (SELECT COUNT(*) FROM members m JOIN feb_bucketed b ON m.msno = b.msno WHERE b.bucket < p.percentage) AS member_rows,
       (SELECT COUNT(*) FROM tx JOIN feb_bucketed b ON tx.msno = b.msno WHERE b.bucket < p.percentage) AS transaction_rows,
       (SELECT COUNT(*) FROM dl JOIN feb_bucketed b ON dl.msno = b.msno WHERE b.bucket < p.percentage) AS listening_rows
FROM p"""


@register("scaling_inventory", _sample_counts_sql())
def scaling_inventory(spark, sf):
    return X.scaling_inventory(pipeline.clean(spark, sf))


@register("scaling_sample", f"""
SELECT g.msno, strftime(g.event_date, '%Y-%m-%d') AS event_date_raw, SUM(g.total_secs) AS total_secs
FROM user_logs g JOIN feb_bucketed b ON g.msno = b.msno
WHERE b.bucket < 10 AND g.event_date BETWEEN DATE '{FEB}' - 29 AND DATE '{FEB}'
GROUP BY g.msno, g.event_date""", doubles=("total_secs",))
def scaling_sample(spark, sf):
    return X.read_sample(spark, scaling_stage(spark, sf), "logs", 10)


@register("scaling_features", f"SELECT * FROM february_features WHERE {O.bucket()} < 10",
          doubles=("auto_renew_rate_90", "total_secs_30"))
def scaling_features(spark, sf):
    return X.scaling_features(spark, scaling_stage(spark, sf), 10)


O.view("scaling_summary_sql", f"""
SELECT CAST(p.percentage AS INTEGER) AS percentage, 'Spark DataFrame' AS platform, COUNT(f.msno) AS output_rows,
       COUNT(DISTINCT f.msno) AS distinct_users,
       CAST(COALESCE(SUM(f.transaction_count_90), 0) AS BIGINT) AS transaction_count_checksum,
       CAST(COALESCE(SUM(f.active_days_30), 0) AS BIGINT) AS active_days_checksum,
       COALESCE(SUM(f.total_secs_30), 0.0) AS listening_seconds_checksum
FROM (VALUES {PCT_VALUES}) p(percentage) LEFT JOIN february_features f ON {O.bucket('f.msno')} < p.percentage
GROUP BY p.percentage""")


@register("scaling_summary", "SELECT * FROM scaling_summary_sql", doubles=("listening_seconds_checksum",))
def scaling_summary(spark, sf):
    return X.scaling_summary(spark, scaling_stage(spark, sf))


RECONCILE_EXACT = ["output_rows", "distinct_users", "transaction_count_checksum", "active_days_checksum"]


@register("reconcile_summaries", """
SELECT percentage, TRUE AS output_rows_matches, TRUE AS distinct_users_matches,
       TRUE AS transaction_count_checksum_matches, TRUE AS active_days_checksum_matches,
       TRUE AS listening_seconds_checksum_matches, TRUE AS all_outputs_match
FROM scaling_summary_sql""")
def reconcile_summaries(spark, sf):
    """V1: the DataFrame route vs the mergeable-partials route over the same samples."""
    inputs = scaling_stage(spark, sf)
    left = X.scaling_summary(spark, inputs)
    right = None
    for p in PCTS:
        s = X.feature_checksum(X.scaling_features_from_partials(spark, inputs, p)).select(
            F.lit(p).alias("percentage"), "*")
        right = s if right is None else right.unionByName(s)
    return reconcile(left, right, ["percentage"], RECONCILE_EXACT, ["listening_seconds_checksum"], fail=True)
