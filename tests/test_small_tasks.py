"""Tasks of the written stages follow the rows of the tables, whatever number the session sets."""

from __future__ import annotations

import datetime as dt

import pytest

from cohortlake import session
from cohortlake.plans.stages import stage
from cohortlake.session import ADVISORY, PARTITIONS, small_tasks


@pytest.fixture
def tables(spark, tmp_path):
    """Customers, orders (one without a key, one key twice), line items and events of this test."""
    day = dt.datetime(2001, 1, 5)
    frames = {
        "customer": spark.createDataFrame([(k, 1, "FURNITURE") for k in range(10)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": spark.createDataFrame([(k, k % 10, day) for k in range(1, 41)] + [(7, 3, day), (None, 4, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": spark.createDataFrame(
            [(k % 45, k % 5, 3.0, "O", day, "R" if k % 2 else "N") for k in range(1, 151)] + [(None, 1, 3.0, "O", day, "N")],
            "l_orderkey long, l_partkey long, l_quantity double, l_linestatus string, l_shipdate timestamp, l_returnflag string"),
        "events": spark.createDataFrame([(k,) for k in range(7)], "event_id long"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _settings(spark):
    return spark.conf.get(PARTITIONS), spark.conf.get(ADVISORY)


def test_a_stage_is_written_in_tasks_by_the_rows_of_its_tables(spark, tables, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 10)
    before, seen = _settings(spark), []
    stage(spark, tables, "test-small-tasks", lambda base: seen.append(_settings(spark)))
    assert seen == [("20", str(session.MERGED_BYTES))]  # 42 orders, 151 line items, 7 events
    assert _settings(spark) == before == ("4", before[1])


def test_larger_numbers_and_smaller_sizes_of_the_session_stay_and_are_put_back(spark):
    before = _settings(spark)
    try:
        spark.conf.set(ADVISORY, "1MB")
        with pytest.raises(ValueError), small_tasks(spark, 10):
            assert _settings(spark) == ("4", str(1 << 20))
            raise ValueError
        assert _settings(spark) == ("4", "1MB")
    finally:
        spark.conf.unset(ADVISORY)
    assert _settings(spark) == before
    assert [session._bytes(x) for x in ("64MB", "8m", "1024b", "512", "2g")] == [64 << 20, 8 << 20, 1024, 512, 2 << 30]
