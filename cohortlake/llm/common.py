"""Shared helpers: reading tables, intermediate results, bounded batches, digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.session import scratch_path

#: Bytes of text that a Python task handles at once.
SLICE_BYTES = 4 << 20
#: Java / RE2 class of the white space that separates words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str, **options) -> DataFrame:
    """``frame`` written to the shared scratch folder and read back.

    Cuts the lineage: what follows survives lost executors without repeating
    the work above, and non-deterministic columns are fixed.  ``options`` are
    the writer's.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    frame.write.parquet(path, **options)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, name: str) -> str:
    """``name`` with underscores in front until no column of ``frame`` has it (in any case)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``limit`` bytes at most.

    A row is never cut; a single longer text is a run of its own.
    """
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.large_binary()).to_pylist()]


def word_count(text):
    """Number of words (runs without ASCII white space) of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
