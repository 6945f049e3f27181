"""Typing, profiling, cleaning and the treatment log, driven by one rule table.

Each rule says, per raw table, which rows are *valid*.  The same predicate is
used three times: counted as invalid in the quality profile, applied as a
filter by the cleaning step (when the rule removes rows), and reported in the
treatment summary.  Predicates are written NULL-safe (``coalesce(.., false)``)
so that a NULL value is invalid both when profiling and when cleaning.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortlake.functions.columns import is_valid_key, parse_yyyymmdd
from cohortlake.schemas import PLAY_COUNT_COLUMNS
from cohortlake.sources.fixtures import RawTables

TABLE_ORDER = ("train", "train_v2", "members_v3", "transactions", "user_logs")


# --------------------------------------------------------------------------- typing
def typed_members(raw: DataFrame) -> DataFrame:
    return raw.withColumn("registration_date", parse_yyyymmdd("registration_init_time"))


def typed_transactions(raw: DataFrame) -> DataFrame:
    return (
        raw.withColumnRenamed("transaction_date", "transaction_date_raw")
        .withColumnRenamed("membership_expire_date", "membership_expire_date_raw")
        .withColumn("transaction_date", parse_yyyymmdd("transaction_date_raw"))
        .withColumn("membership_expire_date", parse_yyyymmdd("membership_expire_date_raw"))
    )


def typed_user_logs(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("date", "event_date_raw").withColumn(
        "event_date", parse_yyyymmdd("event_date_raw")
    )


def typed_views(raw: RawTables) -> dict:
    """The relations the profile reads: labels and members raw, events typed."""
    return {
        "train": raw.train,
        "train_v2": raw.train_v2,
        "members_v3": typed_members(raw.members_v3),
        "transactions": typed_transactions(raw.transactions),
        "user_logs": typed_user_logs(raw.user_logs),
    }


# --------------------------------------------------------------------------- counted rows
#: Number of equal raw rows; a frame with this column holds each raw row once.
COPIES = "copies"


def counted_views(raw: RawTables) -> dict:
    """The typed relations with equal raw rows as one row and their number.

    One shuffle of whole rows for each table, combined in every task before it.
    The quality profile, the duplicate profile and the cleaning all work on the
    result: they weigh rows by ``copies``, count rows, or drop the column.
    """
    return typed_views(RawTables(**{t: f.groupBy(*f.columns).agg(F.count(F.lit(1)).alias(COPIES)) for t, f in raw.as_dict().items()}))


def _weight(frame: DataFrame) -> Column:
    return F.col(COPIES) if COPIES in frame.columns else F.lit(1).cast("long")


# --------------------------------------------------------------------------- rule table
def _ok(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _date_ok(raw_col: str, parsed_col: str) -> Column:
    return F.col(raw_col).isNotNull() & F.col(parsed_col).isNotNull()


@dataclass(frozen=True)
class Rule:
    table: str
    check: str
    measure: str  # name of the count in the long-format profile
    valid: Callable[[], Column]
    treatment: str
    removes_rows: bool


# Fixed texts of the treatment summary (must read exactly like this).
RULES = (
    *(
        Rule(t, "Null or blank msno", "invalid_msno", lambda: _ok(is_valid_key("msno")),
             "Exclude row before aggregation", True)
        for t in TABLE_ORDER
    ),
    *(
        Rule(t, "Target outside {0,1}", "invalid_target", lambda: _ok(F.col("is_churn").isin(0, 1)),
             "Exclude invalid labelled row", True)
        for t in ("train", "train_v2")
    ),
    Rule("members_v3", "Invalid registration date", "invalid_primary_date",
         lambda: _date_ok("registration_init_time", "registration_date"),
         "Retain subscriber but leave tenure missing", False),
    Rule("transactions", "Invalid transaction date", "invalid_primary_date",
         lambda: _date_ok("transaction_date_raw", "transaction_date"),
         "Exclude from dated aggregation", True),
    Rule("transactions", "Invalid expiration date", "invalid_secondary_date",
         lambda: _date_ok("membership_expire_date_raw", "membership_expire_date"),
         "Exclude from dated aggregation", True),
    Rule("transactions", "Renewal or cancel flag outside {0,1}", "invalid_flags",
         lambda: _ok(F.col("is_auto_renew").isin(0, 1) & F.col("is_cancel").isin(0, 1)),
         "Exclude invalid transaction row", True),
    Rule("user_logs", "Invalid listening date", "invalid_primary_date",
         lambda: _date_ok("event_date_raw", "event_date"),
         "Exclude from listening aggregation", True),
    Rule("user_logs", "Missing or negative total_secs", "negative_total_secs",
         lambda: _ok(F.col("total_secs") >= 0),
         "Exclude from listening aggregation", True),
    Rule("user_logs", "Missing or negative play count", "negative_play_counts",
         lambda: reduce(lambda a, b: a & b, [_ok(F.col(c) >= 0) for c in PLAY_COUNT_COLUMNS]),
         "Exclude invalid daily listening row", True),
)

# Rows of the treatment summary that are not single-rule counts.
EXTRA_TREATMENTS = (
    ("exact_duplicate_rows", "Exact duplicate row", "Retain one exact copy"),
)
MEMBER_DUPLICATE_TREATMENT = (
    "members_v3",
    "Duplicate subscriber membership row",
    "Keep latest valid registration deterministically",
)

PROFILE_COLUMNS = (
    "invalid_msno",
    "invalid_target",
    "invalid_primary_date",
    "invalid_secondary_date",
    "negative_total_secs",
    "negative_play_counts",
)


def rules_for(table: str) -> list:
    return [r for r in RULES if r.table == table]


def keep_valid(frame: DataFrame, table: str) -> DataFrame:
    """Filter by every row-removing rule of ``table`` (one conjunctive filter)."""
    preds = [r.valid() for r in rules_for(table) if r.removes_rows]
    return frame.filter(reduce(lambda a, b: a & b, preds))


# --------------------------------------------------------------------------- profiles (O1, O2)
def _profile_one(frame: DataFrame, table: str, extra_measures: bool) -> DataFrame:
    measures, weight = {}, _weight(frame)
    for r in rules_for(table):
        measures[r.measure] = F.sum(F.when(~r.valid(), weight).otherwise(0)).cast("long")
    cols = [
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum(weight), F.lit(0)).cast("long").alias("input_rows"),
        F.count_distinct("msno").alias("distinct_users"),
    ]
    names = PROFILE_COLUMNS + (("invalid_flags",) if extra_measures else ())
    for name in names:
        cols.append(measures.get(name, F.lit(None).cast("long")).alias(name))
    return frame.agg(*cols)


def quality_profile(typed: dict, extra_measures: bool = False) -> DataFrame:
    """O1: one row per raw table; NULL where a check does not apply."""
    parts = [_profile_one(typed[t], t, extra_measures) for t in TABLE_ORDER]
    return reduce(DataFrame.unionByName, parts)


# Columns compared by the exact-duplicate profile (raw text of the dates).
DUPLICATE_COLUMNS = {
    "train": ("msno", "is_churn"),
    "train_v2": ("msno", "is_churn"),
    "members_v3": ("msno", "city", "bd", "gender", "registered_via", "registration_init_time"),
    "transactions": (
        "msno", "payment_method_id", "payment_plan_days", "plan_list_price",
        "actual_amount_paid", "is_auto_renew", "transaction_date_raw",
        "membership_expire_date_raw", "is_cancel",
    ),
    "user_logs": (
        "msno", "event_date_raw", *PLAY_COUNT_COLUMNS, "total_secs",
    ),
}


def exact_duplicates(frame: DataFrame, columns) -> DataFrame:
    """One row: rows_before, exact_distinct_rows (NULLs compare equal).

    Grouping by the whole row is a two-phase hash aggregate: a hot duplicated
    row is combined map-side before the shuffle.  Counted rows are only summed.
    """
    grouped = frame if COPIES in frame.columns else frame.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))
    return grouped.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).cast("long").alias("rows_before"),
        F.count(F.lit(1)).alias("exact_distinct_rows"),
    )


def duplicate_profile(typed: dict) -> DataFrame:
    """O2: rows, exact distinct rows, duplicates per raw table."""
    parts = [
        exact_duplicates(typed[t], DUPLICATE_COLUMNS[t]).select(F.lit(t).alias("table_name"), "*")
        for t in TABLE_ORDER
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "exact_duplicate_rows", F.col("rows_before") - F.col("exact_distinct_rows")
    )


# --------------------------------------------------------------------------- cleaning
def clean_labels(raw: DataFrame) -> DataFrame:
    """Valid key and target; conflicting labels collapse to MAX (churned wins)."""
    return (
        keep_valid(raw, "train")
        .groupBy("msno")
        .agg(F.max("is_churn").cast("int").alias("is_churn"))
    )


def latest_per_key(frame: DataFrame, key: str, order: list) -> DataFrame:
    """First row per key under ``order`` (``row_number() = 1``).

    Spark inserts a partial WindowGroupLimit before the shuffle, so a hot key
    ships at most one row per map task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return frame.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def clean_members(typed_members_frame: DataFrame) -> DataFrame:
    """Valid key, latest registration per subscriber (NULL dates last)."""
    valid = keep_valid(typed_members_frame, "members_v3")
    latest = latest_per_key(
        valid, "msno", [F.col("registration_date").desc(), F.col("registration_init_time").desc()]
    )
    return latest.select("msno", "registration_date")


TRANSACTION_COLUMNS = (
    "msno", "payment_method_id", "payment_plan_days", "plan_list_price",
    "actual_amount_paid", "is_auto_renew", "transaction_date",
    "membership_expire_date", "is_cancel",
)
LOG_COLUMNS = ("msno", "event_date", *PLAY_COUNT_COLUMNS, "total_secs")


def _distinct(frame: DataFrame, columns: tuple) -> DataFrame:
    """Each row once; counted rows are that already.

    Typed columns differ where raw ones do: a text that parses as yyyyMMdd is the
    only one of its date (tests hold this), and rows that do not parse are gone.
    """
    return frame.select(*columns) if COPIES in frame.columns else frame.select(*columns).distinct()


def clean_transactions(typed_tx: DataFrame) -> DataFrame:
    """All rules, then exact dedup on the nine typed columns."""
    return _distinct(keep_valid(typed_tx, "transactions"), TRANSACTION_COLUMNS)


def clean_user_logs(typed_logs: DataFrame) -> DataFrame:
    """C4: all rules, then exact dedup."""
    return _distinct(keep_valid(typed_logs, "user_logs"), LOG_COLUMNS)


@dataclass(frozen=True)
class CleanTables:
    labels_february: DataFrame
    labels_march: DataFrame
    members: DataFrame
    transactions: DataFrame
    user_logs: DataFrame

    def counts_frame(self) -> DataFrame:
        """(table_name, clean_rows_remaining), one aggregate per table."""
        pairs = [
            ("train", self.labels_february),
            ("train_v2", self.labels_march),
            ("members_v3", self.members),
            ("transactions", self.transactions),
            ("user_logs", self.user_logs),
        ]
        parts = [
            f.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("clean_rows_remaining"))
            for t, f in pairs
        ]
        return reduce(DataFrame.unionByName, parts)


def clean_all(raw: RawTables) -> CleanTables:
    return clean_typed(typed_views(raw))


def clean_typed(typed: dict) -> CleanTables:
    """C1-C4 of typed relations, counted or not."""
    return CleanTables(
        labels_february=clean_labels(typed["train"]),
        labels_march=clean_labels(typed["train_v2"]),
        members=clean_members(typed["members_v3"]),
        transactions=clean_transactions(typed["transactions"]),
        user_logs=clean_user_logs(typed["user_logs"]),
    )


# --------------------------------------------------------------------------- treatment (O3)
def _rule_table(spark: SparkSession) -> DataFrame:
    rows = [(r.table, r.check, r.measure, r.treatment) for r in RULES]
    rows += [
        (t, check, measure, treatment)
        for t in TABLE_ORDER
        for measure, check, treatment in EXTRA_TREATMENTS
    ]
    rows.append((*MEMBER_DUPLICATE_TREATMENT[:2], "member_duplicates", MEMBER_DUPLICATE_TREATMENT[2]))
    return spark.createDataFrame(rows, "table_name string, quality_check string, measure string, treatment string")


def treatment_summary(quality: DataFrame, duplicates: DataFrame, after_counts: DataFrame) -> DataFrame:
    """O3: (table, check, affected rows, treatment, clean rows remaining).

    ``quality`` must carry the ``invalid_flags`` measure
    (``quality_profile(..., extra_measures=True)``).  Everything stays a
    DataFrame: the profile is unpivoted and joined to the fixed rule table.
    """
    spark = quality.sparkSession
    measures = list(PROFILE_COLUMNS) + ["invalid_flags"]
    q = quality.join(after_counts, "table_name").withColumn(
        "member_duplicates",
        F.when(F.col("table_name") == "members_v3", F.col("input_rows") - F.col("clean_rows_remaining")),
    )
    q = q.join(duplicates.select("table_name", "exact_duplicate_rows"), "table_name")
    long = q.unpivot(
        ["table_name", "clean_rows_remaining"],
        measures + ["member_duplicates", "exact_duplicate_rows"],
        "measure",
        "value",
    )
    return _rule_table(spark).join(long, ["table_name", "measure"]).select(
        "table_name",
        "quality_check",
        F.coalesce(F.col("value"), F.lit(0)).cast("long").alias("affected_rows"),
        "treatment",
        F.col("clean_rows_remaining").cast("long").alias("clean_rows_remaining"),
    )


# --------------------------------------------------------------------------- date ranges
def date_range_summary(transactions: DataFrame, user_logs: DataFrame) -> DataFrame:
    """Min / max valid date of each clean event table, as ISO text."""
    def one(frame, name, col):
        return frame.agg(
            F.lit(name).alias("table_name"),
            F.min(col).cast("string").alias("minimum_valid_date"),
            F.max(col).cast("string").alias("maximum_valid_date"),
        )

    return one(transactions, "transactions", "transaction_date").unionByName(
        one(user_logs, "user_logs", "event_date")
    )
