"""File sources (S1-S4, S14, S15): typed CSV, gzip CSV parts, Parquet, SQL files, inventory.

CSV is always read with a fixed schema (no inference pass); malformed cells
become NULL (PERMISSIVE).  Gzip files are not splittable, so a directory of
many gzip parts (one per key hash partition) is the parallel layout.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from cohortlake.schemas import RAW_SCHEMAS


def read_csv_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV (plain or gzip, file or directory) under a fixed schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_raw_csv(spark: SparkSession, base: str) -> dict:
    """The five raw tables from ``{base}/{table}``."""
    return {t: read_csv_typed(spark, f"{base}/{t}", s) for t, s in RAW_SCHEMAS.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Whole or partitioned Parquet directory (partition columns inferred)."""
    return spark.read.parquet(path)


# ----------------------------------------------------------------- S14
def sql_text(name: str) -> str:
    return resources.files("cohortlake.sql").joinpath(name).read_text(encoding="utf-8")


def run_sql_file(spark: SparkSession, name: str, frames: dict, params: dict) -> DataFrame:
    """Run a packaged SQL file.

    Relations are passed as DataFrames (``{labels}`` placeholders, bound by
    PySpark's SQL formatter) and values as named parameter markers
    (``:cutoff``); an unbound marker raises ``UNBOUND_SQL_PARAMETER``.
    """
    return spark.sql(sql_text(name), args=params, **frames)


# ----------------------------------------------------------------- S15
def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever file system Spark reads it from."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def file_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every file below ``path``; contents are not read, ``_`` and ``.`` names are left out."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def path_stats(spark: SparkSession, path: str) -> DataFrame:
    """(files, bytes) below ``path`` as a one-row DataFrame; missing path -> (0, 0).

    The listing runs as a Spark job over the ``binaryFile`` source with only
    the ``length`` column read (file contents are pruned).  Hidden files and
    ``_SUCCESS`` markers are not counted.
    """
    try:
        return file_lengths(spark, path).agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"),
        )
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.range(1).select(F.lit(0).cast("long").alias("files"), F.lit(0).cast("long").alias("bytes"))


def inventory(spark: SparkSession, entries: list, label_col: str = "storage_layer",
              path_col: str = "path") -> DataFrame:
    """Files, bytes, GiB and existence for ``[(label, path), ...]``."""
    frames = [
        path_stats(spark, p).select(F.lit(label).alias(label_col), F.lit(p).alias(path_col), "files", "bytes")
        for label, p in entries
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("gibibytes", F.col("bytes") / F.lit(1024 ** 3)).withColumn("exists", F.col("files") > 0)


def require_all_exist(index: DataFrame, label_col: str = "category") -> DataFrame:
    """Fail inside the plan when an expected output holds no files."""
    return index.withColumn(
        "exists",
        F.when(F.col("exists"), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("Missing expected output: "), F.col(label_col)))
        ),
    )
