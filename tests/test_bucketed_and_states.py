"""Bucketed inputs, member states, row differences, bounds from footers."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from cohortlake.operators import quality as q
from cohortlake.operators.differences import differing_ranges, key_differences, row_differences
from cohortlake.plans import curate, pipeline
from cohortlake.plans.bucketed import BucketedStore, bucketed_features, write_inputs
from cohortlake.plans.committed import NotCommitted, Store
from cohortlake.plans.footers import date_range_from_footers
from cohortlake.plans.measure import physical_plan
from cohortlake.plans.members import LAYER, RELATION, MemberStore


def _rows(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


# ------------------------------------------------------------------ bucketed storage
@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    return curate.curate(spark, pipeline.clean(spark, SF_SMALL), str(tmp_path_factory.mktemp("curated")))


@pytest.fixture(scope="module")
def bucketed(spark, clean, tmp_path_factory):
    tx, logs = clean.transactions.drop(*curate.TX_PARTITIONS), clean.user_logs.drop(*curate.LOG_PARTITIONS)
    store = BucketedStore(str(tmp_path_factory.mktemp("bucketed")), 4)
    return write_inputs(spark, store, clean.labels_february, clean.labels_march, clean.members, tx, logs)


@pytest.mark.parametrize("cohort", ["february", "march"])
def test_bucketed_features_need_no_exchange_and_are_the_same(spark, clean, bucketed, cohort):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = bucketed_features(spark, bucketed, cohort)
        plan = physical_plan(made, "formatted")
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 4
        rounded = lambda f: f.withColumn("total_secs_30", F.round("total_secs_30", 6))
        assert _rows(rounded(made)) == _rows(rounded(clean.cohort(cohort)))
        assert made.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_are_read_as_they_were_written_or_not_at_all(spark, bucketed):
    with pytest.raises(NotCommitted):
        BucketedStore(bucketed.base, 8).read(spark, "members")
    held = Store(spark, bucketed.base)
    assert held.altered() == []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("written_")]


def test_a_large_bucket_is_written_as_several_files(spark, tmp_path):
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "4k")
        many = spark.range(0, 60000, 1, 8).select(F.lit("hot").alias("msno"), F.col("id"))  # one key's rows
        store = BucketedStore(str(tmp_path), 4)
        store.write(spark, {"many": many})
        assert store.read(spark, "many").agg(F.sum("id")).first()[0] == sum(range(60000))
        assert store.read(spark, "many").select(F.input_file_name()).distinct().count() > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# ------------------------------------------------------------------ member states
def _members(spark, rows):
    raw = spark.createDataFrame(rows, "msno string, registration_init_time string")
    return q.typed_members(raw.select("msno", F.lit(1).alias("city"), F.lit(20).alias("bd"), F.lit("male").alias("gender"), F.lit(3).alias("registered_via"), "registration_init_time"))


MEMBER_ROWS = [
    ("a", "20160101"), ("a", "20170101"), ("a", "20170101"),  # a tie
    ("b", None), ("b", "not a date"),  # no date at all
    ("c", None), ("c", "20150505"), ("d", "bad"), ("d", "20140404"), ("d", "20130303"),
    (None, "20170101"), ("  ", "20170101"), ("e", "20120202"),
]


def test_states_merge_in_any_order_and_grouping(spark, tmp_path):
    expected = _rows(q.clean_members(_members(spark, MEMBER_ROWS)))
    for k, cut in enumerate(itertools.product((2, 9), (False, True))):
        rows = MEMBER_ROWS[::-1] if cut[1] else MEMBER_ROWS
        store = MemberStore(str(tmp_path / str(k)), 4)
        store.merge(_members(spark, rows[: cut[0]]))
        store.merge(_members(spark, rows[cut[0] - 2 :]))  # overlaps
        assert _rows(store.members(spark)) == expected


def test_a_delivery_rewrites_only_ranges_in_which_it_is_newer(spark, tmp_path):
    store = MemberStore(str(tmp_path), 8)
    first = [(f"m{i}", "20150101") for i in range(200)]
    store.merge(_members(spark, first))
    before = {e.part: e.path for e in Store(spark, store.base).entries(LAYER)}
    version = Store(spark, store.base).latest().version
    assert store.merge(_members(spark, first[:50] + [("m7", "20140101"), ("m9", None)])) == []
    assert Store(spark, store.base).latest().version == version
    ranges = store.merge(_members(spark, [("m7", "20160101")]))
    after = {e.part: e.path for e in Store(spark, store.base).entries(LAYER)}
    assert len(ranges) == 1 and [p for p in before if before[p] != after[p]] == [f"p_range={ranges[0]}"]
    got = {r.msno: r.registration_date for r in store.members(spark).collect()}
    assert len(got) == 200 and got["m7"] == dt.date(2016, 1, 1) and got["m8"] == dt.date(2015, 1, 1)
    assert Store(spark, store.base).read(RELATION, layer=LAYER).count() == 200


def test_an_empty_first_delivery(spark, tmp_path):
    store = MemberStore(str(tmp_path), 4)
    store.merge(_members(spark, MEMBER_ROWS).limit(0))
    assert store.members(spark).count() == 0
    store.merge(_members(spark, MEMBER_ROWS))
    assert _rows(store.members(spark)) == _rows(q.clean_members(_members(spark, MEMBER_ROWS)))


# ------------------------------------------------------------------ row differences
def test_a_planted_difference_is_reported_by_key(spark):
    left = spark.range(0, 20000, 1, 6).select((F.col("id") % 997).alias("k"), F.col("id").alias("v"), F.when(F.col("id") % 3 > 0, "x").alias("t"))
    right = left.repartition(3).withColumn("v", F.when(F.col("v") == 1234, -1).otherwise(F.col("v")))
    assert [tuple(r) for r in key_differences(left, right, "k").collect()] == [(1234 % 997, 1, 1)]
    found = {(r.k, r.v, r.t, r.only_left, r.only_right) for r in row_differences(left, right, "k").collect()}
    assert found == {(237, 1234, "x", 1, 0), (237, -1, "x", 0, 1)}
    assert differing_ranges(left, right, "k").count() == 1


def test_copies_and_nulls_count(spark):
    schema = "k string, v int"
    left = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), (None, None), ("b", None)], schema)
    right = spark.createDataFrame([("a", 1), ("b", None), ("b", None), ("b", 0), (None, None)], schema)
    found = {(r.k, r.v): (r.only_left, r.only_right) for r in row_differences(left, right, "k", 8).collect()}
    assert found == {("a", 1): (2, 0), ("b", None): (0, 1), ("b", 0): (0, 1)}
    with pytest.raises(ValueError):
        row_differences(left, right.withColumnRenamed("v", "w"), "k")


def test_equal_tables_are_read_once_each(spark):
    left = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    same = row_differences(left, left.repartition(5).select("v", "k"), "k")
    assert same.columns == ["k", "v", "only_left", "only_right"] and same.count() == 0
    assert row_differences(left.limit(0), left.limit(0), "k").count() == 0
    assert row_differences(left.limit(0), left, "k").agg(F.sum("only_right")).first()[0] == 1000


# ------------------------------------------------------------------ footers
def test_bounds_come_from_the_footers(spark, clean):
    held = Store(spark, clean.base).latest()
    made = date_range_from_footers(held, {"transactions": "transaction_date", "user_logs": "event_date"}, curate.CURATED_LAYER)
    plan = physical_plan(made, "formatted")
    assert "PushedAggregation: [MIN(transaction_date), MAX(transaction_date)]" in plan and "PushedAggregation: [MIN(event_date), MAX(event_date)]" in plan
    assert _rows(made) == _rows(q.date_range_summary(clean.transactions, clean.user_logs))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_bounds_of_a_relation_without_rows_are_null(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit([store.write("none", spark.createDataFrame([], "d date"))])
    assert [tuple(r) for r in date_range_from_footers(store.latest(), {"none": "d"}).collect()] == [("none", None, None)]
