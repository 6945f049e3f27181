"""Measurement helpers (X3, X4): timed materialisation and plan capture."""

from __future__ import annotations

import contextlib
import io
import time

from pyspark.sql import DataFrame


def timed_noop(frame: DataFrame) -> float:
    """Run the whole plan into the ``noop`` sink and return seconds.

    Unlike ``count()``, the noop sink keeps every projected column, so the
    timing covers the real plan; nothing is cached.
    """
    started = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def physical_plan(frame: DataFrame, mode: str = "formatted") -> str:
    """The plan text that ``explain`` prints (capture before caching)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        frame.explain(mode=mode)
    return buf.getvalue()


@contextlib.contextmanager
def cached(frame: DataFrame):
    """Cache a frame that is reused, and always release it afterwards.

    Never ``clearCache()``: the session may be shared with other work.
    """
    frame.cache()
    try:
        yield frame
    finally:
        frame.unpersist()


def runtime_record(spark, job: str, seconds: float, status: str = "complete") -> DataFrame:
    """One row (job, runtime_seconds, status) for a runtime log sink."""
    return spark.createDataFrame([(job, float(seconds), status)], "job string, runtime_seconds double, status string")


def with_timings(metrics: DataFrame, **seconds: float) -> DataFrame:
    """Append measured seconds (e.g. training_seconds) to a metrics row."""
    from pyspark.sql import functions as F

    return metrics.withColumns({k: F.lit(float(v)) for k, v in seconds.items()})


def write_plans(spark, frames: dict, path: str) -> str:
    """X4 + S12: physical plans of named frames as JSON lines (format, physical_plan)."""
    from cohortlake.sinks.writers import write_json

    rows = [(name, physical_plan(f)) for name, f in frames.items()]
    return write_json(spark.createDataFrame(rows, "format string, physical_plan string"), path)
