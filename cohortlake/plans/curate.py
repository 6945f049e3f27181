"""Stage boundary of the pipeline (S6, S7): store the clean tables, read them back.

Writing the clean tables and reading them again cuts the lineage durably (a
lost executor re-reads files instead of recomputing the cleaning), and the
event tables land partitioned by year/month so that as-of windows prune whole
partitions.  The stage lives in a shared folder (see ``session.scratch_path``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortlake.config import CONFIG
from cohortlake.operators.features import build_cohort
from cohortlake.operators.quality import TABLE_ORDER, CleanTables, counted_views
from cohortlake.plans.committed import Store
from cohortlake.sinks.writers import month_layout
from cohortlake.sources.fixtures import RawTables

TX_PARTITIONS = ("tx_year", "tx_month")
LOG_PARTITIONS = ("event_year", "event_month")
#: Layers of a run's store: the typed copy of the raw tables, the clean tables, what is derived.
RAW_LAYER, CURATED_LAYER, FEATURE_LAYER, SCALING_LAYER = "raw_typed", "curated_parquet", "features", "scaling_inputs"
CURATED = ("members", "transactions", "user_logs", "labels_february", "labels_march")


@dataclass(frozen=True)
class CuratedStage:
    base: str
    labels_february: DataFrame
    labels_march: DataFrame
    members: DataFrame
    transactions: DataFrame
    user_logs: DataFrame

    def cohort(self, name: str, cutoff: str | None = None) -> DataFrame:
        labels = self.labels_february if name == "february" else self.labels_march
        return build_cohort(
            labels, self.members, self.transactions, self.user_logs, cutoff or CONFIG.cutoffs[name],
            tx_partitions=TX_PARTITIONS, log_partitions=LOG_PARTITIONS,
        )


def stage_counted_raw(raw: RawTables, base: str) -> dict:
    """Parse the raw tables once, as typed rows with their number of copies, and read them back.

    Profiling, exact-duplicate counting and cleaning each read this copy, the
    columns they use; whole rows are shuffled once, here.  Raw date text stays
    beside the parsed dates, so every profile rule keeps its meaning.
    """
    typed = counted_views(raw)
    store = Store(raw.train.sparkSession, base)
    store.commit([store.write(f"raw_typed_{name}", frame, RAW_LAYER) for name, frame in typed.items()])
    return read_counted(store.spark, base)


def read_counted(spark: SparkSession, base: str) -> dict:
    held = Store(spark, base).latest()
    return {name: held.read(f"raw_typed_{name}") for name in TABLE_ORDER}


def write_features(stage: CuratedStage, cohorts=("february", "march"), cutoffs: dict | None = None) -> dict:
    """B5 stage: each cohort's feature table written and read back (lineage cut)."""
    store = Store(stage.members.sparkSession, stage.base)
    store.commit([store.write(f"features_{name}", stage.cohort(name, (cutoffs or {}).get(name)), FEATURE_LAYER) for name in cohorts])
    return {name: read_features(store.spark, stage.base, name) for name in cohorts}


def read_features(spark: SparkSession, base: str, cohort: str) -> DataFrame:
    return Store(spark, base).read(f"features_{cohort}")


def write_stage(clean: CleanTables, base: str) -> str:
    """Write the clean tables as one commit: readers see all of them or none."""
    store = Store(clean.members.sparkSession, base)
    by_month = {"transactions": ("transaction_date", "tx"), "user_logs": ("event_date", "event")}
    entries = []
    for name in CURATED:
        frame, parts = getattr(clean, name), ()
        if name in by_month:
            frame, parts = month_layout(frame, *by_month[name])
        entries.append(store.write(name, frame, CURATED_LAYER, parts))
    store.commit(entries)
    return base


def read_stage(spark: SparkSession, base: str) -> CuratedStage:
    """The committed clean tables; ``NotCommitted`` where a writer did not come to its end."""
    held = Store(spark, base).latest()
    return CuratedStage(base=base, **{name: held.read(name, layer=CURATED_LAYER) for name in CURATED})


def curate(spark: SparkSession, clean: CleanTables, base: str) -> CuratedStage:
    return read_stage(spark, write_stage(clean, base))
