"""Clean tables, cohort features and segments."""

from __future__ import annotations

from cohortlake import oracle as O
from cohortlake.config import CONFIG
from cohortlake.operators import features as feat
from cohortlake.operators import quality as q
from cohortlake.plans import curate, pipeline
from cohortlake.plans.stages import stage
from cohortlake.registry import register

FEB, MAR = CONFIG.cutoffs["february"], CONFIG.cutoffs["march"]
FEATURE_DOUBLES = ("auto_renew_rate_90", "total_secs_30")


def counted_stage(spark, sf) -> dict:
    """The raw relations, typed and counted, as a stage of their own."""
    base = stage(spark, sf, "counted", lambda b: curate.stage_counted_raw(pipeline.raw(spark, sf), b))
    return curate.read_counted(spark, base)


@register("clean_labels", "SELECT * FROM labels_february")
def clean_labels(spark, sf):
    return q.clean_labels(pipeline.raw(spark, sf).train)


@register("clean_members", "SELECT * FROM members")
def clean_members(spark, sf):
    return pipeline.clean(spark, sf).members


@register("clean_transactions", "SELECT * FROM transactions")
def clean_transactions(spark, sf):
    """C3 from the counted rows: a filter and a projection, no shuffle."""
    return q.clean_transactions(counted_stage(spark, sf)["transactions"])


@register("clean_user_logs", "SELECT * FROM user_logs", doubles=("total_secs",))
def clean_user_logs(spark, sf):
    """C4 from the counted rows."""
    return q.clean_user_logs(counted_stage(spark, sf)["user_logs"])


@register("membership_features", "SELECT * FROM march_membership")
def membership_features(spark, sf):
    t = pipeline.clean(spark, sf)
    return feat.membership_features(t.labels_march, t.members, MAR)


@register("transaction_features", "SELECT * FROM march_transactions", doubles=("auto_renew_rate_90",))
def transaction_features(spark, sf):
    t = pipeline.clean(spark, sf)
    return feat.transaction_features(t.transactions, t.labels_march, MAR)


@register("listening_features", "SELECT * FROM march_listening", doubles=("total_secs_30",))
def listening_features(spark, sf):
    t = pipeline.clean(spark, sf)
    return feat.listening_features(t.user_logs, t.labels_march, MAR)


@register("feature_join", "SELECT * FROM march_features", doubles=FEATURE_DOUBLES)
def feature_join(spark, sf):
    t = pipeline.clean(spark, sf)
    labels = t.labels_march
    return feat.feature_join(
        labels,
        feat.membership_features(labels, t.members, MAR),
        feat.transaction_features(t.transactions, labels, MAR),
        feat.listening_features(t.user_logs, labels, MAR),
    )


@register("cohort_february", "SELECT * FROM february_features", doubles=FEATURE_DOUBLES)
def cohort_february(spark, sf):
    return pipeline.cohort_features(spark, sf, "february")


@register("cohort_march", "SELECT * FROM march_features", doubles=FEATURE_DOUBLES)
def cohort_march(spark, sf):
    return pipeline.cohort_features(spark, sf, "march")


SEGMENTS_SQL = """
SELECT {e} AS engagement_group, {r} AS renewal_group,
       COUNT(*) AS subscribers, CAST(SUM(is_churn) AS BIGINT) AS churners,
       AVG(CAST(is_churn AS DOUBLE)) AS churn_rate
FROM march_features GROUP BY 1, 2
ORDER BY churn_rate DESC, subscribers DESC"""


@register("churn_segments", SEGMENTS_SQL.format(e=O.ENGAGEMENT, r=O.RENEWAL), doubles=("churn_rate",))
def churn_segments(spark, sf):
    return feat.churn_segments(pipeline.cohort_features(spark, sf, "march"))
