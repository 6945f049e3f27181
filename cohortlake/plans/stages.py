"""Written stages shared by several queries of one application.

A stage (curated tables, scaling samples, CSV copies) is written once per
(application, input directory) into the shared scratch folder and reused; the
written files are what later plans read, which also cuts their lineage.

A stage sorts and groups whole rows.  Its tasks are kept small (``session.small_tasks``),
their number follows the rows of the tables, so these steps stay in memory at any size.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import SparkSession

from cohortlake.session import application_id, scratch_path, small_tasks
from cohortlake.sources.tables import event_rows

_WRITTEN: dict = {}
_ROWS: dict = {}


def stage(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    source = (application_id(spark), sf_dir.rstrip("/"))
    key = (*source, name)
    if key not in _WRITTEN:
        if source not in _ROWS:
            _ROWS[source] = event_rows(spark, sf_dir)
        base = scratch_path(spark, name)
        with small_tasks(spark, _ROWS[source]):
            write(base)
        _WRITTEN[key] = base
    return _WRITTEN[key]
