"""Sources and sinks (S1-S15) with round trips through written files."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cohortlake import oracle as O
from cohortlake.catalog.core import SEGMENTS_SQL, counted_stage
from cohortlake.config import CONFIG
from cohortlake.functions.columns import hash_bucket, parse_iso_date
from cohortlake.operators import features as feat
from cohortlake.operators import quality as q
from cohortlake.operators.differences import key_differences
from cohortlake.plans import curate, experiments as X, pipeline
from cohortlake.plans import refresh as R
from cohortlake.plans.bucketed import BucketedStore, bucketed_features, write_inputs
from cohortlake.plans.committed import Store, missing_files, storage_summary, written_relations
from cohortlake.plans.footers import date_range_from_footers
from cohortlake.plans.members import MemberStore
from cohortlake.plans.stages import stage
from cohortlake.registry import register
from cohortlake.schemas import DATE_RANGE_SCHEMA, FEATURE_SCHEMA, SEGMENT_SCHEMA
from cohortlake.sinks import writers as W
from cohortlake.sources import files

FEB, MAR = CONFIG.cutoffs["february"], CONFIG.cutoffs["march"]
FEATURE_DOUBLES = ("auto_renew_rate_90", "total_secs_30")


# ----------------------------------------------------------------- shared written stages
def raw_csv_stage(spark, sf):
    """The five raw relations written as header CSV (the pipeline's raw input)."""
    def write(base):
        for name, frame in pipeline.raw(spark, sf).as_dict().items():
            frame.write.mode("overwrite").options(**W.CSV_TEXT_OPTIONS).csv(f"{base}/{name}")
    return stage(spark, sf, "raw-csv", write)


def curated_stage(spark, sf) -> curate.CuratedStage:
    base = stage(spark, sf, "curated", lambda b: curate.write_stage(q.clean_typed(counted_stage(spark, sf)), b))
    return curate.read_stage(spark, base)


def scaling_stage(spark, sf) -> X.ScalingInputs:
    base = stage(spark, sf, "scaling", lambda b: X.build_scaling_inputs(curated_as_clean(spark, sf), b))
    return X.ScalingInputs(base)


def feature_stage(spark, sf) -> dict:
    """B5 stage: both cohorts' feature tables built from the curated stage, written, read back."""
    def write(base):
        cur = curated_stage(spark, sf)
        for cohort in ("february", "march"):
            W.write_parquet(cur.cohort(cohort), f"{base}/{cohort}")
    base = stage(spark, sf, "features", write)
    return {c: spark.read.parquet(f"{base}/{c}") for c in ("february", "march")}


def curated_as_clean(spark, sf) -> q.CleanTables:
    c = curated_stage(spark, sf)
    return q.CleanTables(c.labels_february, c.labels_march, c.members,
                         c.transactions.drop(*curate.TX_PARTITIONS), c.user_logs.drop(*curate.LOG_PARTITIONS))


# ----------------------------------------------------------------- S1, S3, S4
@register("scan_csv_typed", """
SELECT msno, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid, is_auto_renew,
       NULLIF(transaction_date, '') AS transaction_date, NULLIF(membership_expire_date, '') AS membership_expire_date,
       is_cancel
FROM raw_transactions""")
def scan_csv_typed(spark, sf):
    return files.read_raw_csv(spark, raw_csv_stage(spark, sf))["transactions"]


def _register_scan(table: str, view: str, texts: tuple) -> None:
    """The typed scan of one more raw table; empty text reads back as null."""
    blank = ", ".join(f"NULLIF({c}, '') AS {c}" for c in texts)

    @register(f"scan_csv_typed_{table}", f"SELECT * REPLACE ({blank}) FROM {view}")
    def scan(spark, sf):
        return files.read_raw_csv(spark, raw_csv_stage(spark, sf))[table]


_register_scan("train", "raw_train", ("msno",))
_register_scan("train_v2", "raw_train_v2", ("msno",))
_register_scan("members_v3", "raw_members", ("msno", "gender", "registration_init_time"))
_register_scan("user_logs", "raw_user_logs", ("msno", "date"))


O.view("feb_bucketed", f"SELECT msno, is_churn, {O.bucket()} AS bucket FROM labels_february")


@register("scan_gzip_parts", f"""
SELECT t.msno, strftime(t.transaction_date, '%Y-%m-%d') AS transaction_date_raw,
       strftime(t.membership_expire_date, '%Y-%m-%d') AS membership_expire_date_raw, t.is_auto_renew, t.is_cancel,
       t.transaction_date, t.membership_expire_date
FROM transactions t JOIN feb_bucketed b ON t.msno = b.msno
WHERE b.bucket < 20 AND t.transaction_date BETWEEN DATE '{FEB}' - 89 AND DATE '{FEB}'""")
def scan_gzip_parts(spark, sf):
    tx = X.read_sample(spark, scaling_stage(spark, sf), "transactions", 20)
    return (tx.withColumn("transaction_date", parse_iso_date("transaction_date_raw"))
            .withColumn("membership_expire_date", parse_iso_date("membership_expire_date_raw")))


@register("scan_parquet", """
SELECT *, CAST(year(transaction_date) AS INTEGER) AS tx_year, CAST(month(transaction_date) AS INTEGER) AS tx_month
FROM transactions""")
def scan_parquet(spark, sf):
    (held,) = (e for e in Store(spark, curated_stage(spark, sf).base).entries(curate.CURATED_LAYER) if e.relation == "transactions")
    return files.read_parquet(spark, held.path)


# ----------------------------------------------------------------- S5, S6, S7
@register("sink_parquet_roundtrip", "SELECT * FROM march_features", doubles=FEATURE_DOUBLES)
def sink_parquet_roundtrip(spark, sf):
    path = stage(spark, sf, "features-march",
                 lambda b: W.write_parquet(pipeline.cohort_features(spark, sf, "march"), b))
    return spark.read.parquet(path)


@register("sink_partitioned_year_month", """
SELECT *, CAST(year(event_date) AS INTEGER) AS event_year, CAST(month(event_date) AS INTEGER) AS event_month
FROM user_logs""", doubles=("total_secs",))
def sink_partitioned_year_month(spark, sf):
    return curated_stage(spark, sf).user_logs


@register("stage_roundtrip", "SELECT * FROM march_features", doubles=FEATURE_DOUBLES)
def stage_roundtrip(spark, sf):
    """March features computed from the stored stage, with partition pruning."""
    return curated_stage(spark, sf).cohort("march")


# ----------------------------------------------------------------- S8, S10, S11, S13
@register("sink_report_csv", SEGMENTS_SQL.format(e=O.ENGAGEMENT, r=O.RENEWAL), doubles=("churn_rate",))
def sink_report_csv(spark, sf):
    def write(base):
        W.write_report_csv(feat.churn_segments(pipeline.cohort_features(spark, sf, "march")), base)
    path = stage(spark, sf, "report-segments", write)
    return files.read_csv_typed(spark, path, SEGMENT_SCHEMA)


@register("sink_gzip_by_key", """
SELECT m.msno, strftime(m.registration_date, '%Y-%m-%d') AS registration_date_raw, m.registration_date
FROM members m JOIN feb_bucketed b ON m.msno = b.msno WHERE b.bucket < 20""")
def sink_gzip_by_key(spark, sf):
    members = X.read_sample(spark, scaling_stage(spark, sf), "members", 20)
    return members.withColumn("registration_date", parse_iso_date("registration_date_raw"))


@register("export_features_csv", f"SELECT *, CAST({O.bucket()} AS INTEGER) AS split_bucket FROM february_features",
          doubles=FEATURE_DOUBLES)
def export_features_csv(spark, sf):
    def write(base):
        f = pipeline.cohort_features(spark, sf, "february").withColumn("split_bucket", hash_bucket("msno"))
        W.write_gzip_csv(f, base, key=None)
    path = stage(spark, sf, "export-features", write)
    schema = StructType(FEATURE_SCHEMA.fields + [StructField("split_bucket", IntegerType(), True)])
    return files.read_csv_typed(spark, path, schema)


@register("sink_json_text", """
SELECT 'transactions' AS table_name, CAST(MIN(transaction_date) AS VARCHAR) AS minimum_valid_date,
       CAST(MAX(transaction_date) AS VARCHAR) AS maximum_valid_date FROM transactions
UNION ALL
SELECT 'user_logs', CAST(MIN(event_date) AS VARCHAR), CAST(MAX(event_date) AS VARCHAR) FROM user_logs""")
def sink_json_text(spark, sf):
    def write(base):
        t = pipeline.clean(spark, sf)
        W.write_json_lines(q.date_range_summary(t.transactions, t.user_logs), base)
    path = stage(spark, sf, "json-date-ranges", write)
    return spark.read.schema(DATE_RANGE_SCHEMA).json(path)


# ----------------------------------------------------------------- S14, S15, G5
@register("sql_parameterised", "SELECT * FROM march_transactions", doubles=("auto_renew_rate_90",))
def sql_parameterised(spark, sf):
    t = pipeline.clean(spark, sf)
    return files.run_sql_file(
        spark, "transaction_features.sql",
        frames={"transactions": t.transactions, "labels": t.labels_march},
        params={"cutoff": dt.date.fromisoformat(MAR), "window_days": CONFIG.transaction_days},
    )


def _run_store(spark, sf) -> Store:
    """The curated stage, both feature tables and the scaling samples as one store, in three commits."""
    def write(base):
        cur = curate.curate(spark, pipeline.clean(spark, sf), base)
        curate.write_features(cur)
        X.build_scaling_inputs(q.CleanTables(cur.labels_february, cur.labels_march, cur.members, cur.transactions, cur.user_logs), base)
    return Store(spark, stage(spark, sf, "run-store", write))


@register("storage_inventory")
def storage_inventory(spark, sf):
    """Files and bytes of the raw CSV copy and of the curated layer."""
    return storage_summary(spark, raw_csv_stage(spark, sf), _run_store(spark, sf))


@register("result_index")
def result_index(spark, sf):
    """Every relation that the manifest names, with its files; the query fails where they are gone."""
    return missing_files(written_relations(_run_store(spark, sf)))


CURATED_COUNTS = "\nUNION ALL ".join(f"SELECT 'curated_parquet' AS storage_layer, '{t}' AS relation, count(*) AS rows FROM {t}" for t in curate.CURATED)


@register("storage_inventory_check", "\nUNION ALL ".join(
    f"SELECT 'raw_csv' AS storage_layer, '{t}' AS relation, count(*) AS rows FROM {v}"
    for t, v in (("train", "raw_train"), ("train_v2", "raw_train_v2"), ("members_v3", "raw_members"), ("transactions", "raw_transactions"), ("user_logs", "raw_user_logs"))
) + "\nUNION ALL " + CURATED_COUNTS)
def storage_inventory_check(spark, sf):
    """Rows of the raw CSV files as read, and of the curated relations as their writer counted them."""
    raw = [f.agg(F.lit("raw_csv").alias("storage_layer"), F.lit(t).alias("relation"), F.count(F.lit(1)).alias("rows"))
           for t, f in files.read_raw_csv(spark, raw_csv_stage(spark, sf)).items()]
    curated = written_relations(_run_store(spark, sf), curate.CURATED_LAYER).select("storage_layer", "relation", "rows")
    return reduce(DataFrame.unionByName, [*raw, curated])


O.view("feb_sampled", "SELECT msno FROM feb_bucketed WHERE bucket < 20")


@register("result_index_check", f"""
{CURATED_COUNTS}
UNION ALL SELECT 'features', 'features_february', count(*) FROM february_features
UNION ALL SELECT 'features', 'features_march', count(*) FROM march_features
UNION ALL SELECT 'scaling_inputs', 'labels', count(*) FROM feb_sampled
UNION ALL SELECT 'scaling_inputs', 'members', count(*) FROM members WHERE msno IN (SELECT msno FROM feb_sampled)
UNION ALL SELECT 'scaling_inputs', 'transactions', count(*) FROM transactions
  WHERE msno IN (SELECT msno FROM feb_sampled) AND transaction_date BETWEEN DATE '{FEB}' - 89 AND DATE '{FEB}'
UNION ALL SELECT 'scaling_inputs', 'logs', count(DISTINCT (msno, event_date)) FROM user_logs
  WHERE msno IN (SELECT msno FROM feb_sampled) AND event_date BETWEEN DATE '{FEB}' - 29 AND DATE '{FEB}'""")
def result_index_check(spark, sf):
    """The indexed relations and the rows that their writers counted."""
    return result_index(spark, sf).select("storage_layer", "relation", "rows")


# ----------------------------------------------------------------- A15, A16: refresh by what changed
def _before(frame, day_col: str, values: dict, month: tuple):
    """The table as it was before: late rows missing, some days' values other, one month there that is empty now.

    Late: a third of the subscribers' rows of the last week of the March window.
    Other: ``values`` on the 5th of each month.  There: the rows of ``month`` once
    more, 40 years earlier.
    """
    end = F.lit(MAR).cast("date")
    late = (hash_bucket("msno") < 33) & F.col(day_col).between(F.date_sub(end, 6), end)
    other = F.dayofmonth(day_col) == 5
    early = frame.where((F.year(day_col) == month[0]) & (F.month(day_col) == month[1])).withColumn(day_col, F.add_months(day_col, -480))
    return frame.where(~late).withColumns({c: F.when(other, v).otherwise(F.col(c)) for c, v in values.items()}).unionByName(early)


def _tables_before(t):
    tx = _before(t.transactions, "transaction_date", {"is_cancel": F.lit(1) - F.col("is_cancel")}, (2001, 1))
    logs = _before(t.user_logs, "event_date", {"num_50": F.col("num_50") + 1}, (2001, 2))
    return tx, logs


def _loaded_before(spark, sf, name: str):
    """A store with the partials of the tables as they were before."""
    return R.PartialStore(stage(spark, sf, name, lambda base: R.refresh_partials(R.PartialStore(base), *_tables_before(curated_as_clean(spark, sf)))))


@register("features_incremental_refresh", "SELECT * FROM march_features", doubles=FEATURE_DOUBLES)
def features_incremental_refresh(spark, sf):
    """Partials of the tables as they were before, refreshed from the tables as they are, merged for March."""
    def write(base):
        store = R.PartialStore(base)
        R.refresh_partials(store, *_tables_before(curated_as_clean(spark, sf)))
        R.refresh_changed(store, cur.transactions, cur.user_logs, curate.TX_PARTITIONS, curate.LOG_PARTITIONS)

    cur = curated_stage(spark, sf)
    return R.features_from_partials(spark, R.PartialStore(stage(spark, sf, "daily-partials", write)), cur.labels_march, cur.members, MAR)


def _versions_sql(table: str, day: str, value: str, old: str, month: str) -> str:
    """Each distinct row of a table before and now, with its copies before (b) and now (n)."""
    return f"""SELECT * EXCLUDE (b, n), sum(b) AS b, sum(n) AS n FROM (
      SELECT *, 0 AS b, 1 AS n FROM {table}
      UNION ALL SELECT * REPLACE (CASE WHEN dayofmonth({day}) = 5 THEN {old} ELSE {value} END AS {value}), 1, 0 FROM {table}
        WHERE NOT ({day} BETWEEN DATE '{MAR}' - 6 AND DATE '{MAR}' AND {O.bucket()} < 33)
      UNION ALL SELECT * REPLACE (CAST({day} - INTERVAL 480 MONTH AS DATE) AS {day}), 1, 0 FROM {table} WHERE strftime({day}, '%Y-%m') = '{month}')
    GROUP BY ALL"""


def _changes_sql(table: str, day: str, value: str, old: str, month: str) -> str:
    """Days of a table whose multisets of rows differ, by comparing the rows themselves."""
    return f"""
SELECT '{table}' AS table_name, day, CASE WHEN rows_before = 0 THEN 'new' WHEN rows_now = 0 THEN 'gone' ELSE 'changed' END AS change, rows_before, rows_now
FROM (SELECT {day} AS day, CAST(sum(b) AS BIGINT) AS rows_before, CAST(sum(n) AS BIGINT) AS rows_now, bool_or(b <> n) AS differs
  FROM ({_versions_sql(table, day, value, old, month)})
  GROUP BY day)
WHERE differs"""


@register("refresh_changed_days", _changes_sql("transactions", "transaction_date", "is_cancel", "1 - is_cancel", "2001-01")
          + "\nUNION ALL" + _changes_sql("user_logs", "event_date", "num_50", "num_50 + 1", "2001-02"))
def refresh_changed_days(spark, sf):
    """The days that a refresh finds to have changed, by their digests."""
    cur = curated_stage(spark, sf)
    store = _loaded_before(spark, sf, "partials-before")
    return R.changed_days(store, cur.transactions, cur.user_logs, curate.TX_PARTITIONS, curate.LOG_PARTITIONS)


# ----------------------------------------------------------------- V1: row by row
@register("reconcile_rows", f"""
SELECT msno, CAST(sum(greatest(b - n, 0)) AS BIGINT) AS only_left, CAST(sum(greatest(n - b, 0)) AS BIGINT) AS only_right
FROM ({_versions_sql("transactions", "transaction_date", "is_cancel", "1 - is_cancel", "2001-01")}) WHERE b <> n GROUP BY msno""")
def reconcile_rows(spark, sf):
    """V1: the transactions as they were before against those as they are, row by row, counted by subscriber."""
    now = curated_as_clean(spark, sf)
    return key_differences(_tables_before(now)[0], now.transactions, CONFIG.key)


# ----------------------------------------------------------------- W1, C2: members as a state
@register("members_merged", "SELECT * FROM members")
def members_merged(spark, sf):
    """Member rows in two deliveries that overlap, the second merged into the states of the first."""
    def write(base):
        rows = counted_stage(spark, sf)["members_v3"]
        part = hash_bucket(F.concat_ws("|", "msno", "registration_init_time"))
        store = MemberStore(base, 16)
        store.merge(rows.where(part < 60))
        store.merge(rows.where((part >= 50) | part.isNull()))

    return MemberStore(stage(spark, sf, "member-states", write), 16).members(spark)


# ----------------------------------------------------------------- J1, B4: bucketed storage
@register("features_bucketed", "SELECT * FROM march_features", doubles=FEATURE_DOUBLES)
def features_bucketed(spark, sf):
    """B5 from bucketed inputs: no exchange between the four scans and the features."""
    def write(base):
        t = curated_as_clean(spark, sf)
        write_inputs(spark, BucketedStore(base, 8), t.labels_february, t.labels_march, t.members, t.transactions, t.user_logs)

    return bucketed_features(spark, BucketedStore(stage(spark, sf, "bucketed", write), 8), "march")


# ----------------------------------------------------------------- A9, O4: bounds from footers
@register("date_range_from_footers", """
SELECT 'transactions' AS table_name, CAST(MIN(transaction_date) AS VARCHAR) AS minimum_valid_date, CAST(MAX(transaction_date) AS VARCHAR) AS maximum_valid_date FROM transactions
UNION ALL SELECT 'user_logs', CAST(MIN(event_date) AS VARCHAR), CAST(MAX(event_date) AS VARCHAR) FROM user_logs""")
def date_ranges_from_footers(spark, sf):
    """O4 of the stored clean tables, answered by their files' statistics."""
    held = Store(spark, curated_stage(spark, sf).base).latest()
    return date_range_from_footers(held, {"transactions": "transaction_date", "user_logs": "event_date"}, curate.CURATED_LAYER)
