"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from cohortlake.functions.columns import (
    absent_flag,
    clamp_probability,
    date_window,
    engagement_group,
    guarded_divide,
    hash_bucket,
    is_valid_key,
    parse_iso_date,
    parse_yyyymmdd,
    renewal_group,
)

__all__ = [
    "absent_flag",
    "clamp_probability",
    "date_window",
    "engagement_group",
    "guarded_divide",
    "hash_bucket",
    "is_valid_key",
    "parse_iso_date",
    "parse_yyyymmdd",
    "renewal_group",
]
