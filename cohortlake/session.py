"""Runtime settings on a session handed in by the caller (never builds one).

Only SQL runtime options are set; the session's own shuffle-partition count and
checkpoint directory are respected.  A scratch location for intermediate
files is derived from ``spark.checkpoint.dir`` (a shared, cluster-visible
folder); only a local session, as in tests, may leave it unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
#: Small tasks: input rows for each shuffle partition, and the shuffled bytes up to which AQE merges partitions.
ROWS_A_TASK, MERGED_BYTES = 500_000, 16 << 20
PARTITIONS, ADVISORY = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_DEFAULTS.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def _bytes(text: str) -> int:
    """A size as Spark's settings write it: ``64MB``, ``8m``, ``1024b``."""
    number, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * "bkmgt".index(unit or "b")


@contextmanager
def small_tasks(spark: SparkSession, rows: int):
    """Shuffles planned inside have a partition for at most ``ROWS_A_TASK`` of ``rows`` on average, merged to at most ``MERGED_BYTES``.

    With a fixed number, a task's share grows with the tables until its sorts and hash
    tables spill.  A session's larger number and smaller size stay; both are put back.
    """
    held = {k: spark.conf.get(k, None) for k in (PARTITIONS, ADVISORY)}
    try:
        spark.conf.set(PARTITIONS, str(max(int(spark.conf.get(PARTITIONS)), -(-rows // ROWS_A_TASK))))
        spark.conf.set(ADVISORY, str(min(_bytes(spark.conf.get(ADVISORY)), MERGED_BYTES)))
        yield
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) one."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions expose no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set one only when none is configured."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        # Local runs and tests only: a cluster must name a shared folder itself.
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = os.path.join(tempfile.gettempdir(), "cohortlake-checkpoints")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else (spark.conf.get("spark.app.id", None) or "remote")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate outputs next to the checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/cohortlake-scratch/{name}-{uuid.uuid4().hex[:12]}"
