"""Profiles, checks, filters, projections, dedup and partial aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlake import oracle as O
from cohortlake.catalog.core import counted_stage
from cohortlake.config import CONFIG
from cohortlake.functions.columns import (
    engagement_group,
    hash_bucket,
    is_valid_key,
    parse_iso_date,
    renewal_group,
)
from cohortlake.operators import asof
from cohortlake.operators import features as feat
from cohortlake.operators import joins
from cohortlake.operators import quality as q
from cohortlake.operators import sampling
from cohortlake.plans import pipeline
from cohortlake.plans.experiments import aggregate_first_join, join_experiment_inputs
from cohortlake.registry import register

FEB, MAR = CONFIG.cutoffs["february"], CONFIG.cutoffs["march"]
TX_DAYS, LOG_DAYS = CONFIG.transaction_days, CONFIG.listening_days


# ----------------------------------------------------------------- O1, O2, O3, O4
def _profile_sql(with_flags: bool = False) -> str:
    key_bad = "SUM(CASE WHEN msno IS NULL OR TRIM(msno) = '' THEN 1 ELSE 0 END)"
    target_bad = "SUM(CASE WHEN is_churn IS NULL OR is_churn NOT IN (0, 1) THEN 1 ELSE 0 END)"

    def date_bad(raw, parsed):
        return f"SUM(CASE WHEN {raw} IS NULL OR {parsed} IS NULL THEN 1 ELSE 0 END)"

    plays = " OR ".join(f"COALESCE({c}, -1) < 0" for c in ("num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"))
    flags = "SUM(CASE WHEN is_auto_renew IS NULL OR is_cancel IS NULL OR is_auto_renew NOT IN (0, 1) OR is_cancel NOT IN (0, 1) THEN 1 ELSE 0 END)"

    def row(name, src, target="NULL", d1="NULL", d2="NULL", secs="NULL", play="NULL", flag="NULL"):
        cols = [
            f"'{name}' AS table_name", "COUNT(*) AS input_rows", "COUNT(DISTINCT msno) AS distinct_users",
            f"CAST({key_bad} AS BIGINT) AS invalid_msno", f"CAST({target} AS BIGINT) AS invalid_target",
            f"CAST({d1} AS BIGINT) AS invalid_primary_date", f"CAST({d2} AS BIGINT) AS invalid_secondary_date",
            f"CAST({secs} AS BIGINT) AS negative_total_secs", f"CAST({play} AS BIGINT) AS negative_play_counts",
        ]
        if with_flags:
            cols.append(f"CAST({flag} AS BIGINT) AS invalid_flags")
        return f"SELECT {', '.join(cols)} FROM {src}"

    return "\nUNION ALL\n".join([
        row("train", "raw_train", target=target_bad),
        row("train_v2", "raw_train_v2", target=target_bad),
        row("members_v3", "typed_members", d1=date_bad("registration_init_time", "registration_date")),
        row("transactions", "typed_transactions", d1=date_bad("transaction_date_raw", "transaction_date"),
            d2=date_bad("membership_expire_date_raw", "membership_expire_date"), flag=flags),
        row("user_logs", "typed_user_logs", d1=date_bad("event_date_raw", "event_date"),
            secs="SUM(CASE WHEN total_secs IS NULL OR total_secs < 0 THEN 1 ELSE 0 END)",
            play=f"SUM(CASE WHEN {plays} THEN 1 ELSE 0 END)"),
    ])


O.view("quality_profile_full", _profile_sql(with_flags=True))


@register("quality_profile", _profile_sql())
def quality_profile(spark, sf):
    """O1 from the counted rows."""
    return q.quality_profile(counted_stage(spark, sf))


def _dup_sql() -> str:
    parts = []
    for t, src in (("train", "raw_train"), ("train_v2", "raw_train_v2"), ("members_v3", "raw_members"),
                   ("transactions", "typed_transactions"), ("user_logs", "typed_user_logs")):
        cols = ", ".join(q.DUPLICATE_COLUMNS[t])
        parts.append(f"SELECT '{t}' AS table_name, COUNT(*) AS rows_before, "
                     f"COUNT(DISTINCT row({cols})) AS exact_distinct_rows FROM {src}")
    return ("SELECT table_name, rows_before, exact_distinct_rows, rows_before - exact_distinct_rows AS exact_duplicate_rows"
            " FROM (" + " UNION ALL ".join(parts) + ") p")


O.view("duplicate_profile_all", _dup_sql())


@register("duplicate_profile", "SELECT * FROM duplicate_profile_all")
def duplicate_profile(spark, sf):
    """O2 from the counted rows: sums, no shuffle of rows."""
    return q.duplicate_profile(counted_stage(spark, sf))


O.view("clean_counts", """
SELECT 'train' AS table_name, COUNT(*) AS clean_rows_remaining FROM labels_february
UNION ALL SELECT 'train_v2', COUNT(*) FROM labels_march
UNION ALL SELECT 'members_v3', COUNT(*) FROM members
UNION ALL SELECT 'transactions', COUNT(*) FROM transactions
UNION ALL SELECT 'user_logs', COUNT(*) FROM user_logs""")


def _treatment_sql() -> str:
    rows = []
    for r in q.RULES:
        rows.append((r.table, r.check, f"p.{r.measure}", r.treatment))
    for t in q.TABLE_ORDER:
        rows.append((t, "Exact duplicate row", "d.exact_duplicate_rows", "Retain one exact copy"))
    rows.append(("members_v3", q.MEMBER_DUPLICATE_TREATMENT[1], "p.input_rows - c.clean_rows_remaining",
                 q.MEMBER_DUPLICATE_TREATMENT[2]))
    sel = []
    for table, check, expr, treatment in rows:
        sel.append(
            f"SELECT '{table}' AS table_name, '{check}' AS quality_check, CAST(COALESCE({expr}, 0) AS BIGINT) AS affected_rows, "
            f"'{treatment}' AS treatment, CAST(c.clean_rows_remaining AS BIGINT) AS clean_rows_remaining "
            f"FROM quality_profile_full p JOIN duplicate_profile_all d ON p.table_name = d.table_name "
            f"JOIN clean_counts c ON p.table_name = c.table_name WHERE p.table_name = '{table}'"
        )
    return "\nUNION ALL\n".join(sel)


@register("treatment_summary", _treatment_sql())
def treatment_summary(spark, sf):
    typed = counted_stage(spark, sf)
    clean = q.clean_typed(typed)
    return q.treatment_summary(
        q.quality_profile(typed, extra_measures=True), q.duplicate_profile(typed), clean.counts_frame()
    )


@register("date_range_summary", """
SELECT 'transactions' AS table_name, CAST(MIN(transaction_date) AS VARCHAR) AS minimum_valid_date,
       CAST(MAX(transaction_date) AS VARCHAR) AS maximum_valid_date FROM transactions
UNION ALL
SELECT 'user_logs', CAST(MIN(event_date) AS VARCHAR), CAST(MAX(event_date) AS VARCHAR) FROM user_logs""")
def date_range_summary(spark, sf):
    t = pipeline.clean(spark, sf)
    return q.date_range_summary(t.transactions, t.user_logs)


# ----------------------------------------------------------------- G1, G2, A10
def _grain_sql() -> str:
    parts = []
    for cohort, labels, cut in (("february", "labels_february", FEB), ("march", "labels_march", MAR)):
        parts.append(f"""
SELECT '{cohort}' AS cohort, '{cut}' AS feature_cutoff, (SELECT COUNT(*) FROM {labels}) AS label_rows,
       COUNT(*) AS feature_rows, COUNT(DISTINCT msno) AS distinct_feature_users,
       CAST(COALESCE(SUM(is_churn), 0) AS BIGINT) AS churners,
       COUNT(*) = (SELECT COUNT(*) FROM {labels}) AND COUNT(DISTINCT msno) = (SELECT COUNT(*) FROM {labels})
         AS grain_check_passed
FROM {cohort}_features""")
    return "\nUNION ALL\n".join(parts)


@register("grain_check", _grain_sql())
def grain_check(spark, sf):
    t = pipeline.clean(spark, sf)
    feb = feat.grain_check("february", FEB, pipeline.cohort_features(spark, sf, "february", t), t.labels_february)
    mar = feat.grain_check("march", MAR, pipeline.cohort_features(spark, sf, "march", t), t.labels_march)
    return feb.unionByName(mar)


def _null_sql() -> str:
    parts = []
    for cohort in ("february", "march"):
        for c in CONFIG.feature_columns:
            parts.append(f"SELECT '{cohort}' AS cohort, '{c}' AS feature, "
                         f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_rows FROM {cohort}_features")
    return "\nUNION ALL\n".join(parts)


@register("feature_null_summary", _null_sql())
def feature_null_summary(spark, sf):
    t = pipeline.clean(spark, sf)
    return feat.feature_null_summary("february", pipeline.cohort_features(spark, sf, "february", t)).unionByName(
        feat.feature_null_summary("march", pipeline.cohort_features(spark, sf, "march", t))
    )


CHECKSUM_SQL = """
SELECT COUNT(*) AS output_rows, COUNT(DISTINCT msno) AS distinct_users,
       CAST(COALESCE(SUM(transaction_count_90), 0) AS BIGINT) AS transaction_count_checksum,
       CAST(COALESCE(SUM(active_days_30), 0) AS BIGINT) AS active_days_checksum,
       COALESCE(SUM(total_secs_30), 0.0) AS listening_seconds_checksum
FROM {src}"""


@register("feature_checksum", CHECKSUM_SQL.format(src="march_features"), doubles=("listening_seconds_checksum",))
def feature_checksum(spark, sf):
    return feat.feature_checksum(pipeline.cohort_features(spark, sf, "march"))


# ----------------------------------------------------------------- P1, P2, P7, P8
@register("typed_dates", """
SELECT msno, transaction_date_raw, transaction_date, membership_expire_date_raw, membership_expire_date
FROM typed_transactions""")
def typed_dates(spark, sf):
    typed = q.typed_transactions(pipeline.raw(spark, sf).transactions)
    return typed.select("msno", "transaction_date_raw", "transaction_date",
                        "membership_expire_date_raw", "membership_expire_date")


@register("typed_dates_members", "SELECT * FROM typed_members")
def typed_dates_members(spark, sf):
    return q.typed_members(pipeline.raw(spark, sf).members_v3)


@register("typed_dates_user_logs", "SELECT msno, event_date_raw, event_date FROM typed_user_logs")
def typed_dates_user_logs(spark, sf):
    return q.typed_user_logs(pipeline.raw(spark, sf).user_logs).select("msno", "event_date_raw", "event_date")


@register("typed_dates_iso", """
SELECT msno, strftime(registration_date, '%Y-%m-%d') AS registration_date_raw,
       CAST(try_strptime(strftime(registration_date, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS registration_date
FROM members""")
def typed_dates_iso(spark, sf):
    members = pipeline.clean(spark, sf).members
    iso = members.select("msno", F.date_format("registration_date", "yyyy-MM-dd").alias("registration_date_raw"))
    return iso.withColumn("registration_date", parse_iso_date("registration_date_raw"))


@register("bucket_engagement", f"SELECT msno, {O.ENGAGEMENT} AS engagement_group FROM march_features")
def bucket_engagement(spark, sf):
    return pipeline.cohort_features(spark, sf, "march").select("msno", engagement_group().alias("engagement_group"))


@register("bucket_renewal", f"SELECT msno, {O.RENEWAL} AS renewal_group FROM march_features")
def bucket_renewal(spark, sf):
    return pipeline.cohort_features(spark, sf, "march").select("msno", renewal_group().alias("renewal_group"))


# ----------------------------------------------------------------- F1, F3, F4, F5, F6, F7
@register("filter_valid_key", "SELECT * FROM raw_user_logs WHERE msno IS NOT NULL AND TRIM(msno) <> ''",
          doubles=("total_secs",))
def filter_valid_key(spark, sf):
    return pipeline.raw(spark, sf).user_logs.filter(is_valid_key("msno"))


@register("filter_rules", """
SELECT * FROM typed_user_logs
WHERE msno IS NOT NULL AND TRIM(msno) <> '' AND event_date_raw IS NOT NULL AND event_date IS NOT NULL
  AND total_secs >= 0 AND num_25 >= 0 AND num_50 >= 0 AND num_75 >= 0 AND num_985 >= 0
  AND num_100 >= 0 AND num_unq >= 0""", doubles=("total_secs",))
def filter_rules(spark, sf):
    return q.keep_valid(q.typed_user_logs(pipeline.raw(spark, sf).user_logs), "user_logs")


@register("filter_asof_window",
          f"SELECT * FROM transactions WHERE transaction_date BETWEEN DATE '{FEB}' - {TX_DAYS - 1} AND DATE '{FEB}'")
def filter_asof_window(spark, sf):
    return asof.asof_window(pipeline.clean(spark, sf).transactions, "transaction_date", FEB, TX_DAYS)


@register("hash_bucket", f"SELECT msno, is_churn, {O.bucket()} AS bucket FROM labels_march")
def hash_bucket_q(spark, sf):
    return pipeline.clean(spark, sf).labels_march.withColumn("bucket", hash_bucket("msno"))


@register("hash_sample", f"SELECT msno, is_churn FROM labels_february WHERE {O.bucket()} < 10")
def hash_sample(spark, sf):
    return sampling.hash_sample(pipeline.clean(spark, sf).labels_february, 10)


@register("hash_split", f"""
SELECT msno, {O.bucket()} AS split_bucket,
       CASE WHEN {O.bucket()} < 80 THEN 'train' ELSE 'validation' END AS dataset
FROM february_features WHERE {O.bucket()} IS NOT NULL""")
def hash_split(spark, sf):
    sides = sampling.hash_split(pipeline.cohort_features(spark, sf, "february"))
    train, validation = (f.select("msno", "split_bucket", F.lit(name).alias("dataset")) for f, name in zip(sides, ("train", "validation")))
    return train.unionByName(validation)


# ----------------------------------------------------------------- U2, U4
@register("union_by_name", """
SELECT * FROM march_membership
UNION ALL BY NAME SELECT * FROM march_transactions
UNION ALL BY NAME SELECT * FROM march_listening""", doubles=("auto_renew_rate_90", "total_secs_30"))
def union_by_name(spark, sf):
    t = pipeline.clean(spark, sf)
    labels = t.labels_march
    parts = [
        feat.membership_features(labels, t.members, MAR),
        feat.transaction_features(t.transactions, labels, MAR),
        feat.listening_features(t.user_logs, labels, MAR),
    ]
    return joins.stack_by_name(parts)


@register("dedup_on_key", """
SELECT msno, is_churn FROM (
  SELECT msno, is_churn, ROW_NUMBER() OVER (PARTITION BY msno ORDER BY is_churn DESC NULLS LAST) AS rn
  FROM raw_train) r WHERE rn = 1""")
def dedup_on_key(spark, sf):
    raw = pipeline.raw(spark, sf).train
    return q.latest_per_key(raw, "msno", [F.col("is_churn").desc()])


# ----------------------------------------------------------------- A6, A7, A15, A16
@register("member_features_max", f"""
SELECT msno, CAST(DATE '{FEB}' - MAX(registration_date) AS INTEGER) AS membership_tenure_days
FROM typed_members WHERE msno IS NOT NULL AND TRIM(msno) <> '' GROUP BY msno""")
def member_features_max(spark, sf):
    return feat.member_tenure(q.typed_members(pipeline.raw(spark, sf).members_v3), FEB)


@register("daily_preaggregate", f"""
SELECT msno, event_date, SUM(total_secs) AS total_secs FROM user_logs
WHERE event_date BETWEEN DATE '{FEB}' - {LOG_DAYS - 1} AND DATE '{FEB}' GROUP BY msno, event_date""",
          doubles=("total_secs",))
def daily_preaggregate(spark, sf):
    logs = asof.asof_window(pipeline.clean(spark, sf).user_logs, "event_date", FEB, LOG_DAYS)
    return asof.daily_listening(logs)


@register("tx_features_from_partials", "SELECT * FROM march_transactions", doubles=("auto_renew_rate_90",))
def tx_features_from_partials(spark, sf):
    t = pipeline.clean(spark, sf)
    merged = asof.merge_transaction_partials(asof.partial_transactions(t.transactions), MAR)
    return merged.join(t.labels_march.select("msno"), "msno", "left_semi")


@register("log_features_from_partials", "SELECT * FROM march_listening", doubles=("total_secs_30",))
def log_features_from_partials(spark, sf):
    t = pipeline.clean(spark, sf)
    merged = asof.merge_listening_partials(asof.daily_listening(t.user_logs), MAR)
    return merged.join(t.labels_march.select("msno"), "msno", "left_semi")


# ----------------------------------------------------------------- J3, J4, J5, J7
O.view("feb_join_logs", f"""
SELECT g.msno, g.event_date, g.total_secs FROM user_logs g
WHERE g.msno IN (SELECT msno FROM labels_february)
  AND g.event_date BETWEEN DATE '{FEB}' - {LOG_DAYS - 1} AND DATE '{FEB}'""")
O.view("feb_join_tx", f"""
SELECT t.msno, t.transaction_date, t.is_auto_renew, t.is_cancel FROM transactions t
WHERE t.msno IN (SELECT msno FROM labels_february)
  AND t.transaction_date BETWEEN DATE '{FEB}' - {TX_DAYS - 1} AND DATE '{FEB}'""")


def join_inputs(spark, sf):
    """The February cohort and the windowed event rows."""
    return join_experiment_inputs(pipeline.clean(spark, sf), FEB)


@register("semi_join_cohort", "SELECT * FROM feb_join_logs", doubles=("total_secs",))
def semi_join_cohort(spark, sf):
    labels, logs, _ = join_inputs(spark, sf)
    return asof.restrict_to_cohort(logs, labels)


@register("join_many_to_many", """
SELECT l.msno, COUNT(DISTINCT g.rid) AS listening_rows, COUNT(DISTINCT t.rid) AS transaction_rows,
       COUNT(*) AS joined_rows
FROM labels_february l
JOIN (SELECT *, row_number() OVER () AS rid FROM feb_join_logs) g ON l.msno = g.msno
JOIN (SELECT *, row_number() OVER () AS rid FROM feb_join_tx) t ON l.msno = t.msno
GROUP BY l.msno""")
def join_many_to_many(spark, sf):
    labels, logs, tx = join_inputs(spark, sf)
    return joins.fan_out(logs, tx, "msno", "listening_rows", "transaction_rows").join(
        labels.select("msno"), "msno", "left_semi"
    )


O.view("feb_aggregate_first", """
WITH facts AS (
  SELECT 'label' AS kind, msno, NULL AS event_date, NULL AS total_secs, NULL AS is_auto_renew, NULL AS is_cancel FROM labels_february
  UNION ALL SELECT 'log', msno, event_date, total_secs, NULL, NULL FROM feb_join_logs
  UNION ALL SELECT 'payment', msno, NULL, NULL, is_auto_renew, is_cancel FROM feb_join_tx)
SELECT msno, NULLIF(COUNT(DISTINCT event_date), 0) AS active_days_30, SUM(total_secs) AS total_secs_30,
       NULLIF(COUNT(*) FILTER (kind = 'payment'), 0) AS transaction_count_90, AVG(CAST(is_auto_renew AS DOUBLE)) AS auto_renew_rate_90,
       CASE WHEN COUNT(*) FILTER (kind = 'payment') > 0 THEN COUNT(*) FILTER (is_cancel = 1) END AS cancellation_count_90
FROM facts GROUP BY msno HAVING COUNT(*) FILTER (kind = 'label') > 0""")


@register("join_aggregate_first", "SELECT * FROM feb_aggregate_first", doubles=("total_secs_30", "auto_renew_rate_90"))
def join_aggregate_first(spark, sf):
    return aggregate_first_join(*join_inputs(spark, sf))


@register("join_validated_one_to_one", """
SELECT l.msno, l.is_churn, m.membership_tenure_days,
       CASE WHEN m.msno IS NULL THEN 'left_only' ELSE 'both' END AS _merge
FROM labels_march l
LEFT JOIN (SELECT msno, CAST(DATE '2001-02-28' - registration_date AS INTEGER) AS membership_tenure_days
           FROM members) m ON l.msno = m.msno""")
def join_validated_one_to_one(spark, sf):
    t = pipeline.clean(spark, sf)
    tenure = t.members.select(
        "msno", F.datediff(F.lit(MAR).cast("date"), F.col("registration_date")).alias("membership_tenure_days")
    )
    return joins.join_one_to_one(t.labels_march, tenure)
