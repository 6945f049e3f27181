"""DuckDB oracle on the smallest SF for a spread of registered queries.

The full set runs with ``python tools/check_oracle.py`` (sf0.01).
"""

from __future__ import annotations

import hashlib

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

KEYS = [
    "clean_labels", "clean_members", "clean_transactions", "clean_user_logs", "cohort_february", "churn_segments",
    "quality_profile", "duplicate_profile", "treatment_summary", "grain_check", "feature_null_summary",
    "join_many_to_many", "tx_features_from_partials", "threshold_search", "binary_metrics", "auc_exact",
    "scaling_summary", "stage_roundtrip", "cross_join_broadcast", "features_incremental_refresh",
]
SPARK_TO_DUCK = {
    "StringType": "VARCHAR", "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
    "DateType": "DATE", "BooleanType": "BOOLEAN",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _digest(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def norm(v):
        if v is None:
            return "~"
        if isinstance(v, float):
            return repr(round(v, 6))
        return v.isoformat() if hasattr(v, "isoformat") else str(v)

    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    onames = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(onames)
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    spark_types = {f.name: SPARK_TO_DUCK[type(f.dataType).__name__] for f in df.schema}
    assert spark_types == duck_types
    assert len(rows) == len(orows) > 0
    assert _digest(df.columns, rows) == _digest(onames, orows)


def test_every_query_has_entry_and_entry_runs(spark):
    assert len(E.queries()) >= 72
    assert set(E.oracle_sql()) <= set(E.queries())
    out = E.entry(spark)
    assert out.count() > 0
