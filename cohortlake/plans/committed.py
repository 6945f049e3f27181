"""Written relations that count only once a manifest names them.

A relation is written to a fresh folder that no reader knows.  Its rows and an
order-free digest of their content are taken by the write itself (observed after
the last shuffle, where every row passes once).  Only when all relations of a
commit are written does one small manifest file follow, with a new version: the
previous version's entries, with those of the commit in their place.  Readers open
the folders that the latest manifest names and nothing else, so a writer that dies
half-way leaves the previous version as it was, and a reader that has begun keeps
its files.  Folders that no version names are left to the store's owner.

An entry is a relation, or one part of it (a month); a commit may replace or drop
single parts.  Entries are as few as relations and months.  One writer at a time:
two that commit the same version are found out by the next reader.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortlake.sources.files import inventory, path_exists, path_stats

MANIFEST = "commit string, layer string, relation string, part string, path string, format string, rows long, digest string, schema string"


class NotCommitted(LookupError):
    """No manifest names what was asked for."""


@dataclass(frozen=True)
class Entry:
    layer: str
    relation: str
    part: str | None
    path: str | None
    format: str
    rows: int
    digest: str
    schema: str


def row_hash(columns) -> Column:
    """64 bits of a row's content; a null differs from an absent column's place."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def content(columns) -> list[Column]:
    """Aggregates ``rows`` and ``digest`` (sum of row hashes): equal for equal multisets of rows in any order."""
    hashes = F.sum(row_hash(columns).cast("decimal(20,0)"))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(hashes, F.lit(0)).cast("decimal(38,0)").cast("string").alias("digest")]


@dataclass(frozen=True)
class Snapshot:
    """What one manifest names; it stays readable whatever is committed later."""

    store: Store
    version: int
    held: tuple

    def entries(self, layer: str | None = None) -> list[Entry]:
        """The entries that hold files, by layer, relation and part."""
        found = [e for e in self.held if e.path is not None and layer in (None, e.layer)]
        return sorted(found, key=lambda e: (e.layer, e.relation, e.part or ""))

    def read(self, relation: str, parts: list | None = None, layer: str | None = None, **options) -> DataFrame:
        """A committed relation, or those of its ``parts`` that there are."""
        found = [e for e in self.held if e.relation == relation and layer in (None, e.layer)]
        if not found:
            raise NotCommitted(f"{relation} is in no manifest of {self.store.base}")
        if len({e.layer for e in found}) > 1:
            raise ValueError(f"{relation} is in more than one layer; name it")
        spark, schema = self.store.spark, StructType.fromJson(json.loads(found[0].schema))
        held = [e for e in found if e.path is not None and (parts is None or e.part in parts)]
        if not held:
            return spark.createDataFrame([], schema)
        return spark.read.format(held[0].format).schema(schema).options(**options).load([e.path for e in held])

    def read_bucketed(self, relation: str, layer: str, buckets: int, key: str) -> DataFrame:
        """A relation written with ``bucket_by=(buckets, key)``, as a table whose buckets Spark knows."""
        found = [e for e in self.held if e.relation == relation and e.layer == layer]
        if not found:
            raise NotCommitted(f"{layer}/{relation} is in no manifest of {self.store.base}")
        (held,) = found
        name = "bucketed_" + held.path.rsplit("-", 1)[1]
        schema = StructType.fromJson(json.loads(held.schema)).toDDL()
        self.store.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{held.path}'")
        return self.store.spark.table(name)


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    base: str

    @property
    def manifests(self) -> str:
        return f"{self.base}/manifests"

    # ------------------------------------------------------------- writing
    def write(self, relation: str, frame: DataFrame, layer: str = "data", partition_by: tuple = (), format: str = "parquet", bucket_by: tuple = (), **options) -> Entry:
        """``frame`` in a fresh folder; it is not part of the store before ``commit``.

        ``bucket_by``: number of buckets and the columns that they are made and sorted by.
        """
        mark = uuid.uuid4().hex[:12]
        path = f"{self.base}/{layer}/{relation}-{mark}"
        seen = Observation()
        writer = frame.observe(seen, *content(frame.columns)).write.format(format).options(**options)
        if bucket_by:
            # Spark writes buckets for tables only; this one is dropped, its files stay.
            name = f"written_{mark}"
            writer.bucketBy(*bucket_by).sortBy(*bucket_by[1:]).option("path", path).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")
        else:
            (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
        return Entry(layer, relation, None, path, format, seen.get["rows"], seen.get["digest"], frame.schema.json())

    def write_parts(self, relation: str, frame: DataFrame, part_columns: tuple, layer: str = "data") -> list[Entry]:
        """``frame`` in a fresh folder, an entry for each value of ``part_columns``, and one without a part for the schema.

        Parts are named by their folder; what they hold is read back from the
        written files, an aggregate a part.
        """
        whole = self.write(relation, frame, layer, part_columns)
        columns = [c for c in frame.columns if c not in part_columns]
        held = self.spark.read.schema(frame.schema).parquet(whole.path).groupBy(*part_columns).agg(*content(columns))
        schema = StructType([f for f in frame.schema if f.name in columns]).json()
        parts = []
        for row in held.collect():  # a row for each part
            name = "/".join(f"{c}={row[c]}" for c in part_columns)
            parts.append(Entry(layer, relation, name, f"{whole.path}/{name}", "parquet", row["rows"], row["digest"], schema))
        return [replace(whole, path=None, rows=0, digest="0", schema=schema), *parts]

    def commit(self, entries: list[Entry], gone: list = ()) -> int:
        """A new version: the last one with ``entries`` in place of equal (layer, relation, part), without the ``gone`` ones.

        A relation that is written whole replaces all parts it had.
        """
        before = self.latest()
        last = before.version
        whole = {(e.layer, e.relation) for e in entries if e.part is None and e.path is not None}
        out = {(e.layer, e.relation, e.part) for e in entries} | set(gone)
        kept = [e for e in before.held if (e.layer, e.relation) not in whole and (e.layer, e.relation, e.part) not in out]
        mark = uuid.uuid4().hex
        rows = [(mark, *asdict(e).values()) for e in (*kept, *entries)]
        frame = self.spark.createDataFrame(rows, MANIFEST).withColumn("version", F.lit(last + 1))
        frame.coalesce(1).write.mode("append").partitionBy("version").json(self.manifests)
        return last + 1

    # ------------------------------------------------------------- reading
    def latest(self) -> Snapshot:
        """The latest manifest; version 0 and nothing where there is none."""
        if not path_exists(self.spark, self.manifests):
            return Snapshot(self, 0, ())
        rows = self.spark.read.schema(f"{MANIFEST}, version int").json(self.manifests)
        found = rows.where(F.col("version") == rows.select(F.max("version")).scalar()).collect()
        if len({r["commit"] for r in found}) > 1:
            raise RuntimeError(f"two writers committed version {found[0]['version']} of {self.base}")
        held = tuple(Entry(**{k: v for k, v in r.asDict().items() if k not in ("commit", "version")}) for r in found)
        return Snapshot(self, found[0]["version"] if found else 0, held)

    def entries(self, layer: str | None = None) -> list[Entry]:
        return self.latest().entries(layer)

    def read(self, relation: str, parts: list | None = None, layer: str | None = None, **options) -> DataFrame:
        return self.latest().read(relation, parts, layer, **options)

    def altered(self) -> list[Entry]:
        """Entries whose files no longer hold what was committed, read anew."""
        out = []
        for e in self.entries():
            columns = StructType.fromJson(json.loads(e.schema))
            options = {"header": True} if e.format == "csv" else {}
            now = self.spark.read.format(e.format).schema(columns).options(**options).load(e.path).agg(*content(columns.names)).first()
            if (now["rows"], now["digest"]) != (e.rows, e.digest):
                out.append(e)
        return out


# ----------------------------------------------------------------- inventories
def written_relations(store: Store, layer: str | None = None) -> DataFrame:
    """(storage_layer, relation, path, files, bytes, gibibytes, rows): a row for each entry of the latest manifest.

    Rows are those that the writer counted; files are listed where they lie now.
    """
    out = store.spark.createDataFrame([], "storage_layer string, relation string, path string, files long, bytes long, gibibytes double, rows long")
    for e in store.entries(layer):
        held = path_stats(store.spark, e.path).select(
            F.lit(e.layer).alias("storage_layer"), F.lit(e.relation).alias("relation"), F.lit(e.path).alias("path"), "files", "bytes",
            (F.col("bytes") / F.lit(1024**3)).alias("gibibytes"), F.lit(e.rows).cast("long").alias("rows"))
        out = out.unionByName(held)
    return out


def missing_files(written: DataFrame) -> DataFrame:
    """``written`` with ``exists``; fails inside the plan where a relation with rows has no files."""
    gone = (F.col("files") == 0) & (F.col("rows") > 0)
    text = F.concat(F.lit("Missing expected output: "), F.col("relation"))
    return written.withColumn("exists", F.when(gone, F.raise_error(text)).otherwise(F.lit(True)))


def storage_summary(spark: SparkSession, raw_dir: str, store: Store, layer: str = "curated_parquet") -> DataFrame:
    """Files and bytes of the raw CSV and of the curated layer; other layers of the store are not counted."""
    raw = inventory(spark, [("raw_csv", raw_dir)]).select("storage_layer", "files", "bytes", "gibibytes")
    curated = written_relations(store, layer).groupBy("storage_layer").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.sum("gibibytes").alias("gibibytes"))
    return raw.unionByName(curated)
