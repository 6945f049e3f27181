"""The four jobs end to end on the smallest SF: raw CSV in, indexed outputs out."""

from __future__ import annotations

from conftest import SF_SMALL

from cohortlake.plans import jobs, pipeline
from cohortlake.operators import features as feat
from cohortlake.sinks.writers import CSV_TEXT_OPTIONS


def test_run_all_jobs(spark, tmp_path):
    raw_dir = str(tmp_path / "raw")
    for name, frame in pipeline.raw(spark, SF_SMALL).as_dict().items():
        frame.write.options(**CSV_TEXT_OPTIONS).csv(f"{raw_dir}/{name}")
    run = jobs.Run(str(tmp_path / "run"))
    out = jobs.run_all(spark, raw_dir, run)

    index = out["index"].collect()
    assert {r.path for r in index} <= run.written and len(index) >= 9 and all(r.exists and r.files > 0 for r in index)
    grain = out["curate"]["grain_check"].collect()
    assert [r.grain_check_passed for r in grain] == [True, True]
    assert len(out["curate"]["treatment_summary"].collect()) == 20

    # the job's segments (from CSV and the stored stage) equal the lazy plan's
    expected = feat.churn_segments(pipeline.cohort_features(spark, SF_SMALL, "march"))
    key = lambda r: (r.engagement_group, r.renewal_group, r.subscribers, r.churners)
    assert sorted(map(key, out["curate"]["churn_segments"].collect())) == sorted(map(key, expected.collect()))

    m = out["training"]["metrics"].collect()[0]
    assert m.test_rows == m.tp + m.fp + m.tn + m.fn and 0 <= m.roc_auc <= 1
    assert len(out["experiments"]["scaling_summary"].collect()) == 4
