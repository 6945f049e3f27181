"""Counted raw rows: one shuffle of whole rows serves the profiles and the cleaning."""

from __future__ import annotations

import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from cohortlake.functions.columns import parse_yyyymmdd
from cohortlake.operators import quality as q
from cohortlake.plans import curate, pipeline
from cohortlake.plans.measure import physical_plan


def _rows(frame):
    return sorted(map(repr, frame.collect()))


def test_profiles_and_clean_tables_of_counted_rows_are_the_same(spark, tmp_path):
    raw = pipeline.raw(spark, SF_SMALL)
    plain, counted = q.typed_views(raw), curate.stage_counted_raw(raw, str(tmp_path))
    assert _rows(q.quality_profile(plain, True)) == _rows(q.quality_profile(counted, True))
    assert _rows(q.duplicate_profile(plain)) == _rows(q.duplicate_profile(counted))
    a, b = q.clean_typed(plain), q.clean_typed(counted)
    for name in curate.CURATED:
        assert _rows(getattr(a, name)) == _rows(getattr(b, name)), name


def test_whole_rows_are_shuffled_once(spark, tmp_path):
    raw = pipeline.raw(spark, SF_SMALL)
    for table, frame in q.counted_views(raw).items():
        # Above the raw table: one exchange by the whole row.
        own = physical_plan(getattr(raw, table).select("*"), "simple").count("Exchange")
        assert physical_plan(frame, "simple").count("Exchange") == own + 1, table
    counted = curate.stage_counted_raw(raw, str(tmp_path))
    for clean in (q.clean_transactions(counted["transactions"]), q.clean_user_logs(counted["user_logs"])):
        assert "Exchange" not in physical_plan(clean, "simple")
    plan = physical_plan(q.duplicate_profile(counted), "simple")
    assert "hashpartitioning" not in plan


def test_a_hot_row_is_combined_before_the_shuffle(spark):
    hot = spark.range(0, 3000, 1, 8).select(F.lit("a").alias("msno"), F.lit(1).alias("is_churn"))
    counted = hot.groupBy(*hot.columns).agg(F.count(F.lit(1)).alias(q.COPIES))
    assert counted.collect()[0][q.COPIES] == 3000
    plan = physical_plan(counted, "simple")
    assert plan.index("Exchange") < plan.rindex("HashAggregate")  # a partial aggregate lies below the exchange


def test_a_text_that_parses_is_the_only_one_of_its_date(spark):
    rng = random.Random(1)
    texts = {"".join(rng.choice("0123456789+- /") for _ in range(rng.randint(6, 11))) for _ in range(4000)}
    texts |= {f"{s}{y}{m:02}{d:02}{e}" for y in (2016, 12017, 999) for m in range(0, 14) for d in range(0, 33) for s in ("", "+", "-", " ", "0") for e in ("", " ")}
    parsed = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("d", parse_yyyymmdd("t")).where("d IS NOT NULL")
    assert parsed.count() > 300 and parsed.groupBy("d").count().where("count > 1").collect() == []
