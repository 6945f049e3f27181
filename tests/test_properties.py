"""Property tests: equivalent plans give equal rows on random small inputs."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings, strategies as st

from cohortlake.operators import asof, features as feat, joins

CUT = "2017-01-31"
keys = st.sampled_from(["a", "b", "c", "d", " a "])
days = st.integers(min_value=-100, max_value=5)
tx_rows = st.lists(
    st.tuples(keys, st.integers(0, 1), days, st.integers(-20, 40), st.integers(0, 1)), min_size=0, max_size=30
)
log_rows = st.lists(st.tuples(keys, days, st.floats(0, 1000, allow_nan=False)), min_size=0, max_size=30)
label_keys = st.sets(keys, min_size=1, max_size=4)
SETTINGS = settings(max_examples=8, deadline=None)


def _tx(spark, rows):
    base = dt.date(2017, 1, 31)
    data = [(k, r, base + dt.timedelta(days=d), base + dt.timedelta(days=e), c) for k, r, d, e, c in rows]
    return spark.createDataFrame(
        data, "msno string, is_auto_renew int, transaction_date date, membership_expire_date date, is_cancel int")


def _logs(spark, rows):
    base = dt.date(2017, 1, 31)
    return spark.createDataFrame([(k, base + dt.timedelta(days=d), s) for k, d, s in rows],
                                 "msno string, event_date date, total_secs double")


def _labels(spark, ks):
    return spark.createDataFrame([(k, 0) for k in sorted(ks)], "msno string, is_churn int")


def _sorted(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()),
                  key=repr)


@SETTINGS
@given(rows=tx_rows, ks=label_keys)
def test_cohort_aggregate_equals_restricting_first(spark, rows, ks):
    tx, labels = _tx(spark, rows), _labels(spark, ks)
    windowed = asof.asof_window(tx, "transaction_date", CUT, 90)
    agg = lambda f: asof.transaction_aggregates(f, CUT)
    after = feat.cohort_aggregate(windowed, labels, agg)
    assert _sorted(after) == _sorted(agg(asof.restrict_to_cohort(windowed, labels)))


@SETTINGS
@given(rows=tx_rows, logs=log_rows)
def test_partials_merge_to_direct_aggregates(spark, rows, logs):
    tx = _tx(spark, rows)
    direct = asof.transaction_aggregates(asof.asof_window(tx, "transaction_date", CUT, 90), CUT)
    merged = asof.merge_transaction_partials(asof.partial_transactions(tx), CUT)
    assert _sorted(direct) == _sorted(merged)
    g = _logs(spark, logs)
    direct_g = asof.listening_aggregates(asof.asof_window(g, "event_date", CUT, 30), CUT)
    merged_g = asof.merge_listening_partials(asof.daily_listening(g), CUT)
    assert _sorted(direct_g) == _sorted(merged_g)


@SETTINGS
@given(rows=tx_rows, logs=log_rows)
def test_fan_out_counts_the_join(spark, rows, logs):
    tx, g = _tx(spark, rows), _logs(spark, logs)
    total = joins.fan_out(g, tx).agg({"joined_rows": "sum"}).collect()[0][0] or 0
    assert total == g.join(tx, "msno").count()
