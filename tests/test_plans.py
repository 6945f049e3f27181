"""Plan assertions: pruning reaches the scan, no fan-out, written stages are used."""

from __future__ import annotations

from conftest import SF_SMALL

from cohortlake.plans import curate, pipeline
from cohortlake.plans.measure import physical_plan
from cohortlake.session import scratch_path


def test_stage_plan_prunes_partitions_and_columns(spark):
    stage = curate.curate(spark, pipeline.clean(spark, SF_SMALL), scratch_path(spark, "test-curated"))
    plan = physical_plan(stage.cohort("march"))
    assert "PartitionFilters: [((tx_year" in plan
    assert "PartitionFilters: [((event_year" in plan
    assert "PushedFilters: [IsNotNull(transaction_date), GreaterThanOrEqual(transaction_date,2000-12-01)" in plan
    # the 2-column label scan reads 2 columns, the log scan only what it aggregates
    assert "ReadSchema: struct<msno:string,event_date:date,total_secs:double>" in plan


def test_feature_join_keeps_label_grain(spark):
    t = pipeline.clean(spark, SF_SMALL)
    f = pipeline.cohort_features(spark, SF_SMALL, "march", t)
    n_labels = t.labels_march.count()
    assert f.count() == n_labels == f.select("msno").distinct().count()


def test_partial_aggregation_before_shuffle(spark):
    t = pipeline.clean(spark, SF_SMALL)
    plan = physical_plan(pipeline.cohort_features(spark, SF_SMALL, "march", t), "simple")
    assert "partial_count" in plan and "partial_max" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_row_number_gets_partial_group_limit(spark):
    plan = physical_plan(pipeline.clean(spark, SF_SMALL).members, "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_fan_out_and_threshold_search_pair_no_rows(spark):
    from cohortlake.operators import joins
    from cohortlake.operators import model as M

    a = spark.createDataFrame([("k", 1)], "msno string, x int")
    plan = physical_plan(joins.fan_out(a, a), "simple")
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    scored = spark.createDataFrame([("k", 1, 0.5)], "msno string, is_churn int, p1 double")
    plan = physical_plan(M.threshold_search(scored), "simple")
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_refresh_merge_prunes_month_partitions(spark, tmp_path):
    import datetime as dt

    from cohortlake.plans import refresh as R

    tx = spark.createDataFrame(
        [("a", 1, dt.date(2016, 6, 1), dt.date(2016, 7, 1), 0), ("a", 1, dt.date(2017, 1, 10), dt.date(2017, 2, 1), 0)],
        "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int")
    logs = spark.createDataFrame([("a", dt.date(2017, 1, 30), 1.0)], "msno string, event_date date, total_secs double")
    store = R.refresh_partials(R.PartialStore(str(tmp_path / "p")), tx, logs)
    labels = spark.createDataFrame([("a", 0)], "msno string, is_churn int")
    members = spark.createDataFrame([("a", dt.date(2016, 1, 1))], "msno string, registration_date date")
    made = R.features_from_partials(spark, store, labels, members, "2017-01-31")
    months = {f.split("p_year=")[1].rsplit("/", 1)[0] for f in made.inputFiles() if "p_year=" in f}
    assert months == {"2017/p_month=1"}  # of the files held, only the window's months are opened
