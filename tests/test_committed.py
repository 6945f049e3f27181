"""Committed stores and the refresh that finds what changed."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortlake.plans import curate, experiments as X, refresh as R
from cohortlake.plans.committed import NotCommitted, Store, content, missing_files, storage_summary, written_relations
from cohortlake.plans.measure import physical_plan
from cohortlake.operators import quality as q
from cohortlake.sinks import writers as W
from cohortlake.sources.files import read_parquet

TX = "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int"
LOGS = "msno string, event_date date, total_secs double"


def test_only_committed_relations_are_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(NotCommitted):
        store.read("a")
    entry = store.write("a", spark.range(5))
    assert read_parquet(spark, entry.path).count() == 5
    with pytest.raises(NotCommitted):
        store.read("a")
    assert store.commit([entry]) == 1
    assert store.read("a").count() == entry.rows == 5


def test_a_write_that_dies_leaves_the_last_version(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit([store.write("a", spark.range(3)), store.write("b", spark.range(4))])
    dies = spark.range(0, 1000, 1, 8).withColumn("id", F.when(F.col("id") == 900, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        store.commit([store.write("a", spark.range(100)), store.write("b", dies)])
    assert (store.read("a").count(), store.read("b").count(), store.latest().version) == (3, 4, 1)

    fresh = str(tmp_path / "curated")
    tables = q.CleanTables(spark.range(1), spark.range(1), dies, *[spark.range(3).withColumn(c, F.lit(dt.date(2017, 1, 1))).withColumn("msno", F.lit("a")) for c in ("transaction_date", "event_date")])
    with pytest.raises(PySparkException):
        curate.write_stage(tables, fresh)
    with pytest.raises(NotCommitted):
        curate.read_stage(spark, fresh)


def test_a_reader_keeps_its_version(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit([store.write("a", spark.range(3))])
    before = store.latest()
    store.commit([store.write("a", spark.range(9)), store.write("empty", spark.range(0))])
    assert before.read("a").count() == 3 and store.read("a").count() == 9 and store.read("empty").count() == 0


def test_parts_are_replaced_and_dropped_one_by_one(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    frame = spark.range(12).select("id", (F.col("id") % 3).cast("int").alias("m"))
    store.commit(store.write_parts("a", frame, ("m",)))
    paths = {e.part: e.path for e in store.entries()}
    store.commit(store.write_parts("a", spark.createDataFrame([(100, 1)], "id long, m int"), ("m",)), [("data", "a", "m=2")])
    now = {e.part: (e.path, e.rows) for e in store.entries()}
    assert now["m=0"] == (paths["m=0"], 4) and now["m=1"][0] != paths["m=1"] and set(now) == {"m=0", "m=1"}
    assert sorted(r.id for r in store.read("a").collect()) == [0, 3, 6, 9, 100]
    assert store.read("a", ["m=7"]).collect() == [] and store.altered() == []


def test_two_writers_of_a_version_are_found(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    entry = store.write("a", spark.range(3))
    store.commit([entry])
    again = spark.read.json(store.manifests).withColumn("commit", F.lit("another"))
    again.cache().count()  # a second writer that saw version 0 too
    again.write.mode("append").partitionBy("version").json(store.manifests)
    with pytest.raises(RuntimeError):
        store.read("a")


def test_altered_and_missing_files_are_found(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit([store.write("a", spark.range(3)), store.write("b", spark.createDataFrame([(1, None), (None, 1)], "x int, y int"))])
    assert store.altered() == []
    (b,) = [e for e in store.entries() if e.relation == "b"]
    spark.createDataFrame([(1, None), (1, None)], "x int, y int").write.mode("overwrite").parquet(b.path)
    assert [e.relation for e in store.altered()] == ["b"]
    spark.range(0).filter("id > 0").write.mode("overwrite").parquet(b.path)
    written = written_relations(store)
    gone = written.withColumn("files", F.when(F.col("relation") == "b", 0).otherwise(F.col("files")))
    assert {r.exists for r in missing_files(written).collect()} == {True}
    with pytest.raises(PySparkException, match="Missing expected output: b"):
        missing_files(gone).collect()


def test_content_knows_order_no_and_copies_yes(spark):
    of = lambda rows: spark.createDataFrame(rows, "x int, y int").agg(*content(["x", "y"])).first()
    assert of([(1, 2), (3, None)]) == of([(3, None), (1, 2)])
    assert of([(1, None)]) != of([(None, 1)])
    assert of([(1, 2)] * 2 + [(3, 4)]) != of([(1, 2)] + [(3, 4)] * 2)


def test_storage_summary_counts_the_curated_layer_only(spark, tmp_path):
    raw = tmp_path / "raw"
    spark.range(3).write.options(**W.CSV_TEXT_OPTIONS).csv(str(raw))
    store = Store(spark, str(tmp_path / "run"))
    store.commit([store.write("t", spark.range(1000), "raw_typed"), store.write("t", spark.range(7), "curated_parquet")])
    found = {r.storage_layer: r for r in storage_summary(spark, str(raw), store).collect()}
    (curated,) = written_relations(store, "curated_parquet").collect()
    assert set(found) == {"raw_csv", "curated_parquet"} and found["curated_parquet"].bytes == curated.bytes > 0 and curated.rows == 7


# ----------------------------------------------------------------- refresh
def _tables(spark, seed: int, days=120):
    rng = random.Random(seed)
    day = lambda: dt.date(2017, 1, 1) + dt.timedelta(days=rng.randrange(days))
    tx = [(rng.choice("abcd"), rng.randint(0, 1), day(), day(), rng.randint(0, 1)) for _ in range(300)]
    logs = [(rng.choice("abcd"), day(), float(rng.randint(0, 9))) for _ in range(300)]
    return tx, logs


def test_changed_days_are_the_true_ones(spark, tmp_path):
    tx, logs = _tables(spark, 1)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    store = R.refresh_partials(R.PartialStore(str(tmp_path)), frame(tx, TX), frame(logs, LOGS))
    assert R.changed_days(store, frame(tx[::-1], TX), frame(logs[::-1], LOGS)).collect() == []  # order is no change
    version = store.open(spark).latest().version
    assert R.refresh_changed(store, frame(tx, TX), frame(logs, LOGS)) == {"transactions": [], "user_logs": []}
    assert store.open(spark).latest().version == version

    now_tx = [r for r in tx if r[2].month != 3] + [("new", 1, dt.date(2018, 5, 1), dt.date(2018, 6, 1), 0)]  # a month emptied, one new
    now_tx = [(k, 1 - a, d, e, c) if d == tx[0][2] else (k, a, d, e, c) for k, a, d, e, c in now_tx]  # a day changed
    now_logs = logs + [logs[5]]  # a copy more
    truth = set()
    for name, old, new, at in (("transactions", tx, now_tx, 2), ("user_logs", logs, now_logs, 1)):
        for day in {r[at] for r in old + new}:
            b, n = sorted(r for r in old if r[at] == day), sorted(r for r in new if r[at] == day)
            if b != n:
                truth.add((name, day, "new" if not b else "gone" if not n else "changed", len(b), len(n)))
    found = R.changed_days(store, frame(now_tx, TX), frame(now_logs, LOGS))
    assert {tuple(r) for r in found.collect()} == truth

    paths = {(e.relation, e.part): e.path for e in store.open(spark).entries()}
    rewritten = R.refresh_changed(store, frame(now_tx, TX), frame(now_logs, LOGS))
    months = {n: sorted({(d.year, d.month) for t, d, *_ in truth if t == n}) for n in ("transactions", "user_logs")}
    assert rewritten == months
    after = {(e.relation, e.part): e.path for e in store.open(spark).entries()}
    assert ("tx_daily", "p_year=2017/p_month=3") not in after and ("tx_daily", "p_year=2018/p_month=5") in after
    same = {k for k in after if k[1] and after[k] == paths.get(k)}
    assert same == {k for k in paths if k[1] and tuple(int(x.split("=")[1]) for x in k[1].split("/")) not in months[{"tx_daily": "transactions", "log_daily": "user_logs"}[k[0]]]}
    fresh = R.refresh_partials(R.PartialStore(str(tmp_path / "fresh")), frame(now_tx, TX), frame(now_logs, LOGS))
    labels = spark.createDataFrame([(k, 0) for k in "abcd"], "msno string, is_churn int")
    members = spark.createDataFrame([("a", dt.date(2016, 1, 1))], "msno string, registration_date date")
    made = [sorted(map(tuple, R.features_from_partials(spark, s, labels, members, "2017-04-20").collect())) for s in (store, fresh)]
    assert made[0] == made[1]
    assert R.changed_days(store, frame(now_tx, TX), frame(now_logs, LOGS)).collect() == []


def test_refresh_loads_a_store_that_was_never_loaded(spark, tmp_path):
    tx, logs = _tables(spark, 2)
    store = R.PartialStore(str(tmp_path))
    assert R.refresh_changed(store, spark.createDataFrame(tx, TX), spark.createDataFrame(logs, LOGS)) == {"transactions": None, "user_logs": None}
    assert {e.relation for e in store.open(spark).entries()} == {"tx_daily", "log_daily", "tx_days", "log_days"}


# ----------------------------------------------------------------- samples
def test_samples_are_cut_as_the_tables_are_read(spark):
    clean = q.CleanTables(*[spark.createDataFrame([("a", 1)], "msno string, is_churn int")] * 2, spark.createDataFrame([("a", dt.date(2016, 1, 1))], "msno string, registration_date date"),
                          spark.createDataFrame([("a", 1, dt.date(2017, 1, 5), dt.date(2017, 2, 1), 0)], TX), spark.createDataFrame([("a", dt.date(2017, 1, 30), 1.0)], LOGS))
    cut = X._sampled(clean, "2017-01-31", (1, 100))
    assert cut["transactions"].count() == 1 and cut["logs"].count() == 1
    for table in ("members", "transactions", "logs"):
        plan = physical_plan(cut[table], "simple").splitlines()
        scans = [i for i, line in enumerate(plan) if "LocalTableScan" in line or "Scan ExistingRDD" in line]
        for i in scans:  # the first shuffle above a scan lies above the filter by sha2
            above = [line for line in plan[:i][::-1]]
            first = next(k for k, line in enumerate(above) if "Exchange" in line)
            assert any("sha2" in line for line in above[:first]), "\n".join(plan)
    strategy = X.join_strategy(clean, "2017-01-31", sample=(1000, 1000)).collect()
    assert {r.output_rows for r in strategy} == {1}
    assert {r.sample_subscribers for r in X.join_strategy(clean, "2017-01-31", sample=(0, 1000)).collect()} == {0}
