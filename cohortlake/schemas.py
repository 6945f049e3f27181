"""Fixed schemas of the raw inputs, the scaling samples and the feature table."""

from pyspark.sql import types as T


def _struct(spec):
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

LABEL_SCHEMA = _struct([("msno", S), ("is_churn", I)])

MEMBER_SCHEMA = _struct(
    [
        ("msno", S),
        ("city", I),
        ("bd", I),
        ("gender", S),
        ("registered_via", I),
        ("registration_init_time", S),
    ]
)

TRANSACTION_SCHEMA = _struct(
    [
        ("msno", S),
        ("payment_method_id", I),
        ("payment_plan_days", I),
        ("plan_list_price", I),
        ("actual_amount_paid", I),
        ("is_auto_renew", I),
        ("transaction_date", S),
        ("membership_expire_date", S),
        ("is_cancel", I),
    ]
)

LOG_SCHEMA = _struct(
    [
        ("msno", S),
        ("date", S),
        ("num_25", L),
        ("num_50", L),
        ("num_75", L),
        ("num_985", L),
        ("num_100", L),
        ("num_unq", L),
        ("total_secs", D),
    ]
)

RAW_SCHEMAS = {
    "train": LABEL_SCHEMA,
    "train_v2": LABEL_SCHEMA,
    "members_v3": MEMBER_SCHEMA,
    "transactions": TRANSACTION_SCHEMA,
    "user_logs": LOG_SCHEMA,
}

# Scaling-sample schemas: dates travel as ISO text.
SAMPLE_MEMBER_SCHEMA = _struct([("msno", S), ("registration_date_raw", S)])
SAMPLE_TX_SCHEMA = _struct(
    [
        ("msno", S),
        ("transaction_date_raw", S),
        ("membership_expire_date_raw", S),
        ("is_auto_renew", I),
        ("is_cancel", I),
    ]
)
SAMPLE_LOG_SCHEMA = _struct([("msno", S), ("event_date_raw", S), ("total_secs", D)])

PLAY_COUNT_COLUMNS = ("num_25", "num_50", "num_75", "num_985", "num_100", "num_unq")

FEATURE_SCHEMA = _struct(
    [
        ("msno", S),
        ("is_churn", I),
        ("membership_tenure_days", I),
        ("transaction_count_90", L),
        ("auto_renew_rate_90", D),
        ("cancellation_count_90", L),
        ("days_since_last_transaction", I),
        ("days_until_expiration", I),
        ("no_recent_transaction", I),
        ("active_days_30", L),
        ("total_secs_30", D),
        ("days_since_last_listen", I),
        ("no_recent_listening", I),
    ]
)

SEGMENT_SCHEMA = _struct(
    [
        ("engagement_group", S),
        ("renewal_group", S),
        ("subscribers", L),
        ("churners", L),
        ("churn_rate", D),
    ]
)

DATE_RANGE_SCHEMA = _struct([("table_name", S), ("minimum_valid_date", S), ("maximum_valid_date", S)])
