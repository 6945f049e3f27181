"""Strategy experiments (E1-E5): join strategy, file format, scaling samples.

Result rows are DataFrames computed by Spark; wall-clock seconds are measured
separately (``bench.py``) so that result columns stay deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortlake.config import CONFIG
from cohortlake.functions.columns import parse_iso_date, parse_yyyymmdd
from cohortlake.operators import asof
from cohortlake.operators.features import feature_checksum, feature_join, member_tenure
from cohortlake.operators.joins import aggregate_then_join, fan_out
from cohortlake.operators.quality import CleanTables, latest_per_key
from cohortlake.operators.sampling import hash_sample, nested_counts, sample_tier
from cohortlake.plans.committed import Store
from cohortlake.plans.curate import LOG_PARTITIONS, SCALING_LAYER, TX_PARTITIONS
from cohortlake.schemas import LOG_SCHEMA
from cohortlake.sinks.writers import CSV_TEXT_OPTIONS, by_key_for_write
from cohortlake.sources.files import file_lengths, read_csv_typed

FEB = CONFIG.cutoffs["february"]
TX_DAYS, LOG_DAYS = CONFIG.transaction_days, CONFIG.listening_days
PCTS = CONFIG.scaling_percentages


# ----------------------------------------------------------------- E1
def event_windows(clean: CleanTables, cutoff: str = FEB) -> tuple[DataFrame, DataFrame]:
    """(transactions, logs) of the windows; tables that are stored by month are read by month."""
    def window(frame, day, days, parts):
        parts = parts if set(parts) <= set(frame.columns) else None
        return asof.asof_window(frame, day, cutoff, days, parts).drop(*(parts or ()))

    return (window(clean.transactions, "transaction_date", TX_DAYS, TX_PARTITIONS),
            window(clean.user_logs, "event_date", LOG_DAYS, LOG_PARTITIONS))


def join_experiment_inputs(clean: CleanTables, cutoff: str = FEB, sample: tuple[int, int] | None = None):
    """Labels and the raw rows of both windows; cohort keys are kept after counting per key.

    ``sample=(n, modulus)`` keeps the keys of ``n`` of ``modulus`` hash buckets; it
    is a function of the key, so it is applied to all three tables as they are read.
    """
    tx, logs = event_windows(clean, cutoff)
    cut = (lambda frame: hash_sample(frame, sample[0], modulus=sample[1])) if sample else (lambda frame: frame)
    return (cut(clean.labels_february),
            cut(logs).select("msno", "event_date", "total_secs"),
            cut(tx).select("msno", "transaction_date", "is_auto_renew", "is_cancel"))


def cohort_fan_out(labels: DataFrame, logs: DataFrame, tx: DataFrame) -> DataFrame:
    """Rows of the raw join per cohort key, from per-key counts."""
    return asof.restrict_to_cohort(fan_out(logs, tx), labels)


def aggregate_first_join(labels: DataFrame, logs: DataFrame, tx: DataFrame, cutoff: str = FEB) -> DataFrame:
    return aggregate_then_join(
        labels.select("msno"),
        [
            (logs, [asof.active_days("event_date", cutoff, LOG_DAYS).alias("active_days_30"), F.sum("total_secs").alias("total_secs_30")]),
            (tx, [
                F.count(F.lit(1)).alias("transaction_count_90"),
                F.avg(F.col("is_auto_renew").cast("double")).alias("auto_renew_rate_90"),
                F.sum(F.when(F.col("is_cancel") == 1, 1).otherwise(0)).cast("long").alias("cancellation_count_90"),
            ]),
        ],
    )


def join_strategy(clean: CleanTables, cutoff: str = FEB, sample: tuple[int, int] | None = None) -> DataFrame:
    """Input sizes and output rows of the raw many-to-many join vs aggregate-first.

    One full outer join of per-key row counts gives both input sizes and the
    raw join's size (sum of count products) in a single pass -- the pairs are
    never materialised.  The aggregate-first result is counted for real.
    """
    labels, logs, tx = join_experiment_inputs(clean, cutoff, sample)
    lc = logs.groupBy("msno").agg(F.count(F.lit(1)).alias("l"))
    tc = tx.groupBy("msno").agg(F.count(F.lit(1)).alias("t"))
    stats = asof.restrict_to_cohort(lc.join(tc, "msno", "full_outer"), labels).agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("input_listening_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("input_transaction_rows"),
        F.coalesce(F.sum(F.col("l") * F.col("t")), F.lit(0)).cast("long").alias("raw_rows"),
    )
    users = labels.select(F.count(F.lit(1))).scalar()
    agg_rows = aggregate_first_join(labels, logs, tx, cutoff).select(F.count(F.lit(1))).scalar()
    with_scalars = stats.select("*", users.alias("users"), agg_rows.alias("agg_rows"))

    def row(name, out):
        return F.struct(
            F.lit(name).alias("strategy"),
            F.col("users").alias("sample_subscribers"),
            F.col("input_listening_rows"),
            F.col("input_transaction_rows"),
            F.col(out).alias("output_rows"),
            (F.col(out) / F.greatest(F.col("users"), F.lit(1))).alias("output_rows_per_subscriber"),
        )

    return with_scalars.select(F.inline(F.array(row("raw_many_to_many_join", "raw_rows"),
                                                row("aggregate_before_join", "agg_rows"))))


# ----------------------------------------------------------------- E2
def window_aggregate(logs: DataFrame, cutoff: str = FEB, days: int = LOG_DAYS,
                     partition_cols: tuple | None = None) -> DataFrame:
    windowed = asof.asof_window(logs, "event_date", cutoff, days, partition_cols)
    return windowed.groupBy("msno").agg(
        asof.active_days("event_date", cutoff, days).alias("active_days_30"),
        F.sum("total_secs").alias("total_secs_30"),
    )


def csv_log_aggregate(spark: SparkSession, csv_path: str, cutoff: str = FEB) -> DataFrame:
    """E2, CSV side: raw logs under the fixed schema, parsed, window + seconds >= 0."""
    raw = read_csv_typed(spark, csv_path, LOG_SCHEMA).withColumn("event_date", parse_yyyymmdd("date"))
    return window_aggregate(raw.filter(F.col("total_secs") >= 0), cutoff)


def format_queries(spark: SparkSession, csv_path: str, parquet_logs: DataFrame, cutoff: str = FEB,
                   partition_cols: tuple | None = None) -> tuple:
    """E2's two plans: (CSV aggregate, Parquet aggregate)."""
    return (csv_log_aggregate(spark, csv_path, cutoff),
            window_aggregate(parquet_logs, cutoff, partition_cols=partition_cols))


def format_experiment(spark: SparkSession, raw_logs: DataFrame | None, parquet_logs: DataFrame, csv_path: str,
                      partition_cols: tuple | None = None, cutoff: str = FEB) -> DataFrame:
    """The same 30-day aggregate from CSV and from Parquet, with a match flag.

    ``raw_logs`` is written to ``csv_path`` first unless it is None (CSV already there).
    """
    if raw_logs is not None:
        raw_logs.write.mode("overwrite").options(**CSV_TEXT_OPTIONS).csv(csv_path)
    csv_q, pq_q = format_queries(spark, csv_path, parquet_logs, cutoff, partition_cols)

    def summary(name, q):
        return q.agg(
            F.lit(name).alias("format"),
            F.count(F.lit(1)).alias("output_users"),
            F.coalesce(F.sum("total_secs_30"), F.lit(0.0)).alias("seconds_checksum"),
        )

    both = summary("CSV", csv_q).unionByName(summary("Parquet", pq_q))
    # The union holds exactly two rows, so one window over all of it is
    # bounded, and each side's aggregate runs once.
    every = Window.partitionBy()
    same_users = F.min("output_users").over(every) == F.max("output_users").over(every)
    spread = F.max("seconds_checksum").over(every) - F.min("seconds_checksum").over(every)
    return both.withColumn("results_match", same_users & (F.abs(spread) < F.lit(0.01)))


# ----------------------------------------------------------------- E3
@dataclass(frozen=True)
class ScalingInputs:
    """The samples in a committed store (``committed.Store``)."""

    base: str


def _sampled(clean: CleanTables, cutoff: str, percentages) -> dict:
    """Rows of each table whose key is in a sample and in the labels, with ``sample_tier``.

    The tier is a function of the key: it filters each table as it is read, so
    only sampled rows meet the label keys.
    """
    def tiered(frame):
        return frame.withColumn("sample_tier", sample_tier(percentages=percentages)).filter(F.col("sample_tier").isNotNull())

    labels = tiered(clean.labels_february)
    tx, logs = event_windows(clean, cutoff)
    cut = lambda frame: tiered(frame).join(labels.select("msno"), "msno", "left_semi")
    return {"labels": labels, "members": cut(clean.members), "transactions": cut(tx), "logs": cut(asof.daily_listening(tiered(logs)))}


def build_scaling_inputs(clean: CleanTables, base: str, cutoff: str = FEB,
                         percentages=PCTS, partitions: int | None = None) -> ScalingInputs:
    """Write the nested hash samples once, as gzip CSV clustered by key.

    Every row carries ``sample_tier`` (the smallest percentage that holds its
    key) and is written into that tier's directory, so the p% sample is the
    set of tiers <= p and each row is stored once, not once per percentage.
    """
    cut = _sampled(clean, cutoff, percentages)
    members = cut["members"].select(
        "msno", F.date_format("registration_date", "yyyy-MM-dd").alias("registration_date_raw"), "sample_tier"
    )
    tx = cut["transactions"].select(
        "msno",
        F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date_raw"),
        F.date_format("membership_expire_date", "yyyy-MM-dd").alias("membership_expire_date_raw"),
        "is_auto_renew",
        "is_cancel",
        "sample_tier",
    )
    logs = cut["logs"].select(
        "msno", F.date_format("event_date", "yyyy-MM-dd").alias("event_date_raw"), "total_secs", "sample_tier"
    )
    # File count follows the data (AQE advisory size) unless ``partitions`` pins it.
    store = Store(clean.members.sparkSession, base)
    tables = {"labels": cut["labels"], "members": members, "transactions": tx, "logs": logs}
    store.commit([
        store.write(name, by_key_for_write(frame, "msno", partitions), SCALING_LAYER, ("sample_tier",), "csv", **CSV_TEXT_OPTIONS, compression="gzip")
        for name, frame in tables.items()
    ])
    return ScalingInputs(base)


def read_sample(spark: SparkSession, inputs: ScalingInputs, table: str, percentage: int) -> DataFrame:
    """S3: the gzip CSV parts of one table for one percentage (partition-pruned)."""
    frame = Store(spark, inputs.base).read(table, layer=SCALING_LAYER, header=True, mode="PERMISSIVE")
    return frame.filter(F.col("sample_tier") <= percentage).drop("sample_tier")


def scaling_inventory(clean: CleanTables, cutoff: str = FEB, percentages=PCTS) -> DataFrame:
    """E3 inventory: rows of every table in every nested sample, one pass per table."""
    cut = _sampled(clean, cutoff, percentages)
    names = {"label_rows": "labels", "member_rows": "members", "transaction_rows": "transactions", "listening_rows": "logs"}
    out = None
    for name, table in names.items():
        counts = nested_counts(cut[table], "sample_tier", percentages, name)
        out = counts if out is None else out.join(counts, "percentage")
    return out


def scaling_input_report(spark: SparkSession, inputs: ScalingInputs, preparation_seconds: float, percentages=PCTS) -> DataFrame:
    """E3 report: rows, files and compressed bytes of every nested sample as written, and the seconds that writing took.

    Read from the committed files; a sample's files are those of the tiers up to it.
    """
    held = Store(spark, inputs.base).latest()
    names = {"labels": "label_rows", "members": "member_rows", "transactions": "transaction_rows", "logs": "listening_rows"}
    out, files = None, None
    for e in held.entries(SCALING_LAYER):
        counts = nested_counts(held.read(e.relation, layer=SCALING_LAYER, header=True), "sample_tier", percentages, names[e.relation])
        out = counts if out is None else out.join(counts, "percentage")
        listed = file_lengths(spark, e.path).withColumn("sample_tier", F.regexp_extract("path", r"sample_tier=(\d+)", 1).cast("int"))
        files = listed if files is None else files.unionByName(listed)
    upto = files.groupBy("sample_tier").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"))
    sizes = upto.agg(*[F.coalesce(F.sum(F.when(F.col("sample_tier") <= p, F.col(x))), F.lit(0)).cast("long").alias(f"{x}{p}") for p in percentages for x in ("n", "b")])
    rows = sizes.select(F.inline(F.array(*[F.struct(F.lit(p).alias("percentage"), F.col(f"n{p}").alias("input_files"), F.col(f"b{p}").alias("compressed_input_bytes")) for p in percentages])))
    order = ["percentage", *names.values()]
    return out.select(*order).join(rows, "percentage").withColumn("preparation_seconds_excluded_from_benchmark", F.lit(float(preparation_seconds)))


# ----------------------------------------------------------------- E4
def dedup_labels(labels: DataFrame) -> DataFrame:
    """U4: one label row per key with a fixed survivor (churned first)."""
    return latest_per_key(labels, "msno", [F.col("is_churn").desc()])


def typed_sample(spark: SparkSession, inputs: ScalingInputs, percentage: int, cutoff: str = FEB) -> tuple:
    """(labels, tenure per key, transactions, logs) of one sample with their dates."""
    read = lambda table: read_sample(spark, inputs, table, percentage)
    members = read("members").withColumn("registration_date", parse_iso_date("registration_date_raw"))
    tx = read("transactions").withColumns({c: parse_iso_date(f"{c}_raw") for c in ("transaction_date", "membership_expire_date")})
    logs = read("logs").withColumn("event_date", parse_iso_date("event_date_raw")).filter(F.col("total_secs") >= 0)
    return dedup_labels(read("labels")), member_tenure(members, cutoff), tx, logs


def scaling_features(spark: SparkSession, inputs: ScalingInputs, percentage: int, cutoff: str = FEB) -> DataFrame:
    """The feature table rebuilt from one sample (already windowed and cut)."""
    labels, membership, tx, logs = typed_sample(spark, inputs, percentage, cutoff)
    return feature_join(labels, membership, asof.transaction_aggregates(tx, cutoff), asof.listening_aggregates(logs, cutoff))


def scaling_summary(spark: SparkSession, inputs: ScalingInputs, percentages=PCTS,
                    platform: str = "Spark DataFrame") -> DataFrame:
    """E4 summary: control totals per percentage."""
    out = None
    for p in percentages:
        s = feature_checksum(scaling_features(spark, inputs, p)).select(
            F.lit(p).alias("percentage"), F.lit(platform).alias("platform"), "*"
        )
        out = s if out is None else out.unionByName(s)
    return out


def scaling_features_from_partials(spark: SparkSession, inputs: ScalingInputs, percentage: int,
                                   cutoff: str = FEB) -> DataFrame:
    """E4 twin: the same features by the mergeable-partials route."""
    labels, membership, tx, logs = typed_sample(spark, inputs, percentage, cutoff)
    t = asof.merge_transaction_partials(asof.partial_transactions(tx), cutoff)
    g = asof.merge_listening_partials(asof.daily_listening(logs), cutoff)
    return feature_join(labels, membership, t, g)


# ----------------------------------------------------------------- E5
def stage_timings(spark: SparkSession, inputs: ScalingInputs, percentage: int, cutoff: str = FEB) -> dict:
    """E5: seconds of the feature steps of one sample (labels+members, transactions,
    listening, join) -- each step run whole into the noop sink."""
    from cohortlake.plans.measure import timed_noop

    labels, membership, tx, logs = typed_sample(spark, inputs, percentage, cutoff)
    t = asof.transaction_aggregates(tx, cutoff)
    g = asof.listening_aggregates(logs, cutoff)
    return {
        "labels_and_members_seconds": timed_noop(labels.join(membership, "msno", "left")),
        "transaction_aggregation_seconds": timed_noop(t),
        "listening_aggregation_seconds": timed_noop(g),
        "join_seconds": timed_noop(feature_join(labels, membership, t, g)),
    }
