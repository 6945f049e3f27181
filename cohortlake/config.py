"""One frozen configuration object for the whole pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PipelineConfig:
    key: str = "msno"
    # Cohort cutoffs of the test fixtures (FIXTURES.md section 4).
    cutoffs: dict = field(
        default_factory=lambda: {"february": "2001-01-31", "march": "2001-02-28"}
    )
    transaction_days: int = 90
    listening_days: int = 30
    bucket_modulus: int = 100
    train_buckets: int = 80
    scaling_percentages: tuple = (1, 5, 10, 20)
    # Threshold grid 0.10 ... 0.90 step 0.05, kept as integer percents.
    threshold_grid: tuple = tuple(range(10, 91, 5))
    engagement_high_days: int = 20
    engagement_moderate_days: int = 5
    renewal_auto_rate: float = 0.5
    log_loss_epsilon: float = 1e-15
    max_iterations: int = 100
    # Feature names of the feature table, in this order.
    feature_columns: tuple = (
        "membership_tenure_days",
        "transaction_count_90",
        "auto_renew_rate_90",
        "cancellation_count_90",
        "days_since_last_transaction",
        "days_until_expiration",
        "no_recent_transaction",
        "active_days_30",
        "total_secs_30",
        "days_since_last_listen",
        "no_recent_listening",
    )
    nullable_features: tuple = (
        "membership_tenure_days",
        "days_since_last_transaction",
        "days_until_expiration",
        "days_since_last_listen",
    )


CONFIG = PipelineConfig()
