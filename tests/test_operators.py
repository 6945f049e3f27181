"""Hand-made edge rows per operator (FIXTURES.md section 5)."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortlake.functions.columns import (
    engagement_group,
    hash_bucket,
    is_valid_key,
    parse_yyyymmdd,
    renewal_group,
)
from cohortlake.operators import features as feat
from cohortlake.operators import joins
from cohortlake.operators import model as M
from cohortlake.operators import quality as q
from cohortlake.operators.asof import asof_window, window_months
from cohortlake.operators.reconcile import reconcile
from cohortlake.operators.sampling import hash_sample, hash_split

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


def test_key_validity(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" a ",), ("a",)], "msno string")
    assert rows(df.filter(is_valid_key("msno"))) == [(" a ",), ("a",)]


def test_date_text_never_raises(spark):
    df = spark.createDataFrame([("20170131",), ("20170231",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_yyyymmdd("t")).collect()]
    assert got == [D(2017, 1, 31), None, None, None]


def test_label_conflict_takes_max(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 2)], "msno string, is_churn int")
    assert rows(q.clean_labels(df)) == [("a", 1), ("b", 0)]


def test_latest_member_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", "20150101"), ("a", "20150231"), ("b", "")], "msno string, registration_init_time string"
    )
    got = rows(q.clean_members(q.typed_members(df)))
    assert got == [("a", D(2015, 1, 1)), ("b", None)]


def test_null_in_duplicate_counts_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "msno string, x int")
    r = q.exact_duplicates(df, ["msno", "x"]).collect()[0]
    assert (r.rows_before, r.exact_distinct_rows) == (3, 2)


def test_window_edges_inclusive(spark):
    df = spark.createDataFrame(
        [(D(2016, 11, 2),), (D(2016, 11, 3),), (D(2017, 1, 31),), (D(2017, 2, 1),)], "d date"
    )
    got = [r[0] for r in asof_window(df, "d", "2017-01-31", 90).orderBy("d").collect()]
    assert got == [D(2016, 11, 3), D(2017, 1, 31)]


def test_window_months():
    assert window_months("2017-01-31", 90) == [(2016, 11), (2016, 12), (2017, 1)]
    assert window_months("2001-02-28", 30) == [(2001, 1), (2001, 2)]


def _events(spark):
    labels = spark.createDataFrame([("a", 1), ("b", 0)], "msno string, is_churn int")
    members = spark.createDataFrame([("a", D(2016, 1, 31))], "msno string, registration_date date")
    tx = spark.createDataFrame(
        [("a", 1, D(2017, 1, 10), D(2017, 1, 20), 0), ("z", 1, D(2017, 1, 10), D(2017, 2, 20), 1)],
        "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int",
    )
    logs = spark.createDataFrame(
        [("a", D(2017, 1, 30), 10.0), ("a", D(2017, 1, 30), 5.0), ("z", D(2017, 1, 30), 1.0)],
        "msno string, event_date date, total_secs double",
    )
    return labels, members, tx, logs


def test_cohort_features_absence_expiry_and_days(spark):
    labels, members, tx, logs = _events(spark)
    f = {r.msno: r for r in feat.build_cohort(labels, members, tx, logs, "2017-01-31").collect()}
    assert set(f) == {"a", "b"}  # the event-only key 'z' is not in any feature row
    a, b = f["a"], f["b"]
    assert a.membership_tenure_days == 366
    assert a.days_until_expiration == -11  # expiry before the cutoff is negative
    assert a.days_since_last_transaction == 21
    assert (a.active_days_30, a.total_secs_30) == (1, 15.0)  # one day, seconds summed
    assert (a.no_recent_transaction, a.no_recent_listening) == (0, 0)
    assert (b.transaction_count_90, b.auto_renew_rate_90, b.active_days_30, b.total_secs_30) == (0, 0.0, 0, 0.0)
    assert (b.days_since_last_transaction, b.days_since_last_listen, b.membership_tenure_days) == (None, None, None)
    assert (b.no_recent_transaction, b.no_recent_listening) == (1, 1)


def test_cohort_features_without_broadcast(spark):
    """The large-cohort path (aggregate first, no broadcast) gives the same rows."""
    labels, members, tx, logs = _events(spark)
    small = rows(feat.build_cohort(labels, members, tx, logs, "2017-01-31"))
    t = feat.transaction_features(tx, labels, "2017-01-31", restrict=True)
    big = feat.cohort_aggregate(
        asof_window(tx, "transaction_date", "2017-01-31", 90), labels,
        lambda f: feat.transaction_aggregates(f, "2017-01-31"),
    )
    assert rows(t) == rows(big)
    assert len(small) == 2


def test_segment_edges(spark):
    df = spark.createDataFrame(
        [(0, 4, 0, 0.49), (0, 5, 0, 0.5), (0, 19, 1, 0.0), (0, 20, 0, 1.0), (1, 0, 0, 0.0)],
        "no_recent_listening int, active_days_30 int, no_recent_transaction int, auto_renew_rate_90 double",
    )
    got = [tuple(r) for r in df.select(engagement_group(), renewal_group()).collect()]
    assert got == [
        ("Low activity", "Mostly manual renewal"),
        ("Moderately active", "Mostly auto-renew"),
        ("Moderately active", "No recent transaction"),
        ("Highly active", "Mostly auto-renew"),
        ("No recent listening", "Mostly manual renewal"),
    ]


def test_hash_bucket_values(spark):
    df = spark.createDataFrame([("abc",), (None,)], "msno string")
    assert [r[0] for r in df.select(hash_bucket("msno")).collect()] == [54, None]


def test_split_is_partition_and_samples_nest(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("msno"))
    train, valid = hash_split(df)
    t, v = {r.msno for r in train.collect()}, {r.msno for r in valid.collect()}
    assert not (t & v) and len(t | v) == 2000
    s5 = {r.msno for r in hash_sample(df, 5).collect()}
    s20 = {r.msno for r in hash_sample(df, 20).collect()}
    assert s5 <= s20 and 0 < len(s5) < len(s20)


def test_one_class_only_weights(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "msno string, is_churn int")
    w = {r["class"]: r.class_weight for r in M.class_weight_table(df).collect()}
    # total / (2 n_class): 2 / 4 for the present class, 0 for the absent one
    assert w == {"non_churn": 0.5, "churn": 0.0}
    assert [r.class_weight for r in M.add_class_weights(df).collect()] == [0.5, 0.5]


def test_threshold_no_positive_predicted(spark):
    df = spark.createDataFrame([("a", 1, 0.05), ("b", 0, 0.01)], "msno string, is_churn int, p1 double")
    t = M.threshold_search(df).collect()
    assert len(t) == 17 and all((r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0) for r in t)


def test_threshold_tie_prefers_recall_then_lower(spark):
    # every threshold up to 0.5 gives the same counts -> same f1 and recall -> 0.10 wins
    df = spark.createDataFrame([("a", 1, 0.55), ("b", 0, 0.05)], "msno string, is_churn int, p1 double")
    best = M.best_threshold(M.threshold_search(df)).collect()[0]
    assert best.threshold == 0.1 and best.f1 == 1.0


def test_threshold_search_equals_cross_join(spark):
    import random

    rnd = random.Random(7)
    data = [(str(i), rnd.randint(0, 1), round(rnd.random(), 3)) for i in range(500)]
    df = spark.createDataFrame(data, "msno string, is_churn int, p1 double")
    got = {r.threshold: (r.tp, r.fp, r.fn) for r in M.threshold_search(df).collect()}
    for v in range(10, 91, 5):
        t = v / 100.0
        tp = sum(1 for _, y, p in data if y == 1 and p >= t)
        fp = sum(1 for _, y, p in data if y == 0 and p >= t)
        fn = sum(1 for _, y, p in data if y == 1 and p < t)
        assert got[t] == (tp, fp, fn)


def test_log_loss_extremes_finite(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("b", 0, 1.0)], "msno string, is_churn int, p1 double")
    r = M.binary_metrics(df, 0.5).collect()[0]
    assert math.isfinite(r.log_loss) and r.log_loss > 30


def test_exact_auc_matches_pairwise_definition(spark):
    import random

    rnd = random.Random(3)
    data = [(str(i), rnd.randint(0, 1), rnd.randint(0, 20) / 20.0) for i in range(300)]
    df = spark.createDataFrame(data, "msno string, is_churn int, p1 double")
    got = M.exact_auc(df, buckets=7).collect()[0]
    pos = [p for _, y, p in data if y == 1]
    neg = [p for _, y, p in data if y == 0]
    u = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    assert got.roc_auc == pytest.approx(u / (len(pos) * len(neg)), abs=1e-12)


def test_grain_check_raises_on_duplicate_member(spark):
    labels = spark.createDataFrame([("a", 1)], "msno string, is_churn int")
    members = spark.createDataFrame([("a", D(2016, 1, 1)), ("a", D(2016, 2, 1))], "msno string, registration_date date")
    empty_tx = spark.createDataFrame(
        [], "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int")
    empty_logs = spark.createDataFrame([], "msno string, event_date date, total_secs double")
    features = feat.build_cohort(labels, members, empty_tx, empty_logs, "2017-01-31")
    with pytest.raises(Exception, match="grain check failed"):
        feat.grain_check("march", "2017-01-31", features, labels).collect()
    ok = feat.grain_check("march", "2017-01-31", feat.build_cohort(
        labels, members.limit(0), empty_tx, empty_logs, "2017-01-31"), labels).collect()[0]
    assert ok.grain_check_passed is True


def test_join_one_to_one_raises_and_indicates(spark):
    left = spark.createDataFrame([("a",), ("b",)], "msno string")
    right = spark.createDataFrame([("a", 1)], "msno string, v int")
    got = rows(joins.join_one_to_one(left, right))
    assert got == [("a", 1, "both"), ("b", None, "left_only")]
    dup = right.unionByName(right)
    with pytest.raises(Exception, match="not unique"):
        joins.join_one_to_one(left, dup).collect()


def test_fan_out_equals_materialised_join(spark):
    a = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3)], "msno string, x int")
    b = spark.createDataFrame([("k", 1), ("k", 2), ("k", 3), ("n", 4)], "msno string, y int")
    fan = {r.msno: r.joined_rows for r in joins.fan_out(a, b).collect()}
    assert fan == {"k": 6} and a.join(b, "msno").count() == 6


def test_reconcile_tolerance_and_missing_keys(spark):
    left = spark.createDataFrame([(1, 10, 1.000), (2, 10, 1.000), (3, 10, 1.0)], "p int, n int, s double")
    right = spark.createDataFrame([(1, 10, 1.009), (2, 10, 1.011), (4, 10, 1.0)], "p int, n int, s double")
    got = {r.p: r.all_outputs_match for r in reconcile(left, right, ["p"], ["n"], ["s"]).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}
    with pytest.raises(Exception, match="differs"):
        reconcile(left, right, ["p"], ["n"], ["s"], fail=True).collect()


def test_missing_output_raises(spark, tmp_path):
    from cohortlake.sources.files import inventory, require_all_exist

    present = tmp_path / "present"
    spark.range(3).write.parquet(str(present))
    index = inventory(spark, [("present", str(present)), ("absent", str(tmp_path / "nope"))], label_col="category")
    with pytest.raises(Exception, match="absent"):
        require_all_exist(index).collect()
    ok = require_all_exist(inventory(spark, [("present", str(present))], label_col="category")).collect()[0]
    assert ok.files >= 1 and ok.exists is True


def test_unbound_sql_parameter_raises(spark):
    from cohortlake.sources.files import run_sql_file

    tx = spark.createDataFrame(
        [], "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int")
    labels = spark.createDataFrame([], "msno string")
    with pytest.raises(PySparkException):
        run_sql_file(spark, "transaction_features.sql", {"transactions": tx, "labels": labels},
                     {"cutoff": D(2017, 1, 31)}).collect()


def test_cached_releases_and_runtime_record(spark):
    from cohortlake.plans.measure import cached, runtime_record, timed_noop, with_timings

    df = spark.range(10)
    with cached(df) as c:
        assert c.is_cached and c.count() == 10
    assert not df.is_cached
    rec = runtime_record(spark, "job", 1.5).collect()[0]
    assert (rec.job, rec.runtime_seconds, rec.status) == ("job", 1.5, "complete")
    assert with_timings(spark.range(1), training_seconds=2).collect()[0].training_seconds == 2.0
    assert timed_noop(df) >= 0


def test_show_and_write_roundtrip(spark, tmp_path):
    from cohortlake.sinks.writers import show_and_write

    df = spark.createDataFrame([("  a", 1)], "k string, n int")
    back = show_and_write(df, "test", str(tmp_path / "r"))
    assert [tuple(r) for r in back.collect()] == [("  a", 1)]


def test_plan_capture_written_as_json(spark, tmp_path):
    from cohortlake.plans.measure import write_plans

    path = write_plans(spark, {"a": spark.range(3).filter("id > 1")}, str(tmp_path / "plans"))
    got = spark.read.json(path).collect()[0]
    assert got.format == "a" and "Physical Plan" in got.physical_plan


def test_incremental_refresh_rewrites_only_touched_months(spark, tmp_path):
    from cohortlake.plans import refresh as R

    schema = "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int"
    tx = spark.createDataFrame(
        [("a", 1, D(2016, 12, 5), D(2017, 1, 5), 0), ("a", 0, D(2017, 1, 10), D(2017, 2, 10), 1)], schema)
    logs = spark.createDataFrame([("a", D(2017, 1, 30), 5.0)], "msno string, event_date date, total_secs double")
    labels = spark.createDataFrame([("a", 1)], "msno string, is_churn int")
    members = spark.createDataFrame([("a", D(2016, 1, 31))], "msno string, registration_date date")
    store = R.refresh_partials(R.PartialStore(str(tmp_path / "p")), tx, logs)
    entry = lambda part: [e for e in store.open(spark).entries() if (e.relation, e.part) == ("tx_daily", part)]
    december, january = entry("p_year=2016/p_month=12"), entry("p_year=2017/p_month=1")
    assert len(december) == len(january) == 1

    more = tx.unionByName(spark.createDataFrame([("a", 1, D(2017, 1, 20), D(2017, 3, 1), 0)], schema))
    R.refresh_partials(store, more, logs, days=["2017-01-20"])
    assert entry("p_year=2016/p_month=12") == december  # untouched month kept its files
    assert entry("p_year=2017/p_month=1")[0].path != january[0].path

    row = R.features_from_partials(spark, store, labels, members, "2017-01-31").collect()[0]
    assert row.transaction_count_90 == 3 and row.days_until_expiration == 29
    assert row.active_days_30 == 1 and row.total_secs_30 == 5.0


def test_exact_auc_of_one_class_is_defined(spark):
    df = spark.createDataFrame([("a", 1, 0.2), ("b", 1, 0.9)], "msno string, is_churn int, p1 double")
    assert tuple(M.exact_auc(df).collect()[0]) == (0.0, 1.0)


def test_refresh_drops_a_month_that_lost_its_rows(spark, tmp_path):
    import datetime as dt

    from cohortlake.plans import refresh as R

    tx = spark.createDataFrame([("a", 1, dt.date(2017, 1, 10), dt.date(2017, 2, 1), 0)],
                               "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int")
    logs = spark.createDataFrame([("a", dt.date(2017, 1, 30), 1.0)], "msno string, event_date date, total_secs double")
    store = R.refresh_partials(R.PartialStore(str(tmp_path / "p")), tx, logs)
    R.refresh_partials(store, tx.limit(0), logs.limit(0), days=["2017-01-15"])
    labels = spark.createDataFrame([("a", 0)], "msno string, is_churn int")
    members = spark.createDataFrame([("a", dt.date(2016, 1, 1))], "msno string, registration_date date")
    row = R.features_from_partials(spark, store, labels, members, "2017-01-31").collect()[0]
    assert (row.transaction_count_90, row.active_days_30) == (0, 0)


def test_threshold_search_of_null_scores_and_no_rows(spark):
    rows = spark.createDataFrame([(1, None), (1, 0.5), (0, 0.5), (0, 0.05), (None, 0.9)], "is_churn int, p1 double")
    found = {r.threshold: (r.tp, r.fp, r.fn) for r in M.threshold_search(rows, grid=(10, 50, 60)).collect()}
    assert found == {0.1: (1, 1, 1), 0.5: (1, 1, 1), 0.6: (0, 0, 2)}
    empty = M.threshold_search(rows.limit(0), grid=(10, 50)).collect()
    assert [(r.threshold, r.tp, r.fp, r.fn, r.f1) for r in empty] == [(0.1, 0, 0, 0, 0.0), (0.5, 0, 0, 0, 0.0)]


def test_member_tenure_and_stack_by_name(spark):
    members = spark.sql("SELECT * FROM VALUES ('a', DATE '2017-01-01'), ('a', DATE '2017-01-11'), ('b', NULL), ('  ', DATE '2017-01-01') AS t(msno, registration_date)")
    tenure = feat.member_tenure(members, "2017-01-31")
    assert sorted(map(tuple, tenure.collect())) == [("a", 20), ("b", None)]
    stacked = joins.stack_by_name([tenure, spark.sql("SELECT 'c' AS msno, 1 AS other")])
    assert sorted(map(tuple, stacked.collect())) == [("a", 20, None), ("b", None, None), ("c", None, 1)]


def test_active_days_as_bits(spark):
    import random

    from cohortlake.operators import asof
    from cohortlake.plans.measure import physical_plan

    rng = random.Random(4)
    end = D(2017, 3, 1)
    rows = [(rng.choice("abc"), end - dt.timedelta(days=rng.randint(-5, 220))) for _ in range(800)] + [("d", None)]
    frame = spark.createDataFrame(rows, "msno string, event_date date").repartition(8)
    for days in (1, 30, 64, 65, 200):
        got = {r.msno: r.n for r in frame.groupBy("msno").agg(asof.active_days("event_date", "2017-03-01", days).alias("n")).collect()}
        want = {k: len({d for m, d in rows if m == k and d is not None and 0 <= (end - d).days < days}) for k in "abcd"}
        assert got == want, days
    windowed = frame.withColumn("total_secs", F.lit(1.0))
    plan = physical_plan(asof.listening_aggregates(windowed, "2017-03-01"), "simple")
    assert "Expand" not in plan and plan.count("hashpartitioning") == 1
