"""Change-driven refresh of the windowed features from stored per-day partials.

Per-day partial states (counts, sums, maxima per subscriber and day) are stored
by month in a committed store (``committed.Store``).  Beside them lies, for each
event table and day, an order-free digest of the rows they were made of: their
number and the sum of their hashes.  A refresh takes the same digests of the tables
as they are now (one aggregate with a row a day, combined in every task; no event is
shuffled), compares both in a full outer join and so finds by itself the days that
are new, changed or gone.  Only the months of those days are read and summed
again; a month that lost all its rows leaves the store.  All of it is one commit:
readers see the store before the refresh or after it.

Features for any cutoff merge the day partials inside the window; only the
window's months are opened.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.config import CONFIG
from cohortlake.operators import asof
from cohortlake.operators.features import feature_join
from cohortlake.plans.committed import NotCommitted, Snapshot, Store, content

TX_DAY, LOG_DAY = "transaction_date", "event_date"
PARTITIONS = ("p_year", "p_month")
LAYER = "partials"


@dataclass(frozen=True)
class Kept:
    """An event table's partials in the store."""

    table: str
    day: str
    daily: str
    digests: str
    partial: object


TX = Kept("transactions", TX_DAY, "tx_daily", "tx_days", asof.partial_transactions)
LOGS = Kept("user_logs", LOG_DAY, "log_daily", "log_days", asof.daily_listening)


@dataclass(frozen=True)
class PartialStore:
    base: str

    def open(self, spark: SparkSession) -> Store:
        return Store(spark, self.base)


# ----------------------------------------------------------------- days and months
def day_digests(frame: DataFrame, day: str) -> DataFrame:
    """(day, rows, digest): the content of each day, whatever the order of its rows."""
    return frame.groupBy(F.col(day).alias("day")).agg(*content(frame.columns))


def compare_days(before: DataFrame, now: DataFrame) -> DataFrame:
    """(day, change, rows_before, rows_now) of the days that differ: new, gone or changed."""
    b = before.select("day", F.col("rows").alias("rows_before"), F.col("digest").alias("digest_before"))
    n = now.select("day", F.col("rows").alias("rows_now"), F.col("digest").alias("digest_now"))
    change = (F.when(F.col("digest_before").isNull(), "new").when(F.col("digest_now").isNull(), "gone")
              .when((F.col("rows_before") != F.col("rows_now")) | (F.col("digest_before") != F.col("digest_now")), "changed"))
    both = b.join(n, "day", "full_outer").withColumn("change", change).where("change IS NOT NULL")
    return both.select("day", "change", F.coalesce("rows_before", F.lit(0)).alias("rows_before"), F.coalesce("rows_now", F.lit(0)).alias("rows_now"))


def _months(days: list) -> list:
    return sorted({(d.year, d.month) for d in days})


def _part(month: tuple) -> str:
    return "/".join(f"{c}={v}" for c, v in zip(PARTITIONS, month))


def _in_months(frame: DataFrame, day: str, months: list | None, partitions: tuple | None = None) -> DataFrame:
    """Rows of the months (all when None); as date ranges, which reach the scan, and by the source's folders if it has them."""
    if months is None:
        return frame.drop(*(partitions or ()))
    picked = F.lit(False)
    for y, m in months:
        last = (dt.date(y, m, 28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        month = F.col(day).between(F.lit(dt.date(y, m, 1)), F.lit(last))
        if partitions:
            month &= (F.col(partitions[0]) == y) & (F.col(partitions[1]) == m)
        picked |= month
    return frame.filter(picked).drop(*(partitions or ()))


# ----------------------------------------------------------------- writing
def _summed(store: Store, kept: Kept, frame: DataFrame, months: list | None) -> tuple[list, list]:
    """(entries, gone parts) of the months' partials, written anew."""
    if months == []:
        return [], []
    daily = kept.partial(frame).withColumns({PARTITIONS[0]: F.year(kept.day), PARTITIONS[1]: F.month(kept.day)})
    # REBALANCE on the month lets AQE split a heavy month into several files.
    entries = store.write_parts(kept.daily, daily.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, CONFIG.key), PARTITIONS, LAYER)
    written = {e.part for e in entries}
    parts = [e.part for e in store.entries(LAYER) if e.relation == kept.daily] if months is None else [_part(m) for m in months]
    return entries, [(LAYER, kept.daily, p) for p in parts if p not in written]


def _commit(store: Store, tables: list) -> None:
    """Partials of (kept, frame, months) and the digests of all days, as one version."""
    entries, gone = [], []
    for kept, frame, partitions, months in tables:
        made, lost = _summed(store, kept, _in_months(frame, kept.day, months, partitions), months)
        entries += made
        gone += lost
        if months is None:
            digests = day_digests(frame.drop(*(partitions or ())), kept.day)
        elif months:
            of = F.make_date(F.year("day"), F.month("day"), F.lit(1)).isin([dt.date(y, m, 1) for y, m in months])
            digests = store.read(kept.digests).where(~of).unionByName(day_digests(_in_months(frame, kept.day, months, partitions), kept.day))
        else:
            continue
        entries.append(store.write(kept.digests, digests.coalesce(1), LAYER))  # a row a day
    if entries or gone:
        store.commit(entries, gone)


def refresh_partials(store: PartialStore, transactions: DataFrame, user_logs: DataFrame, days: list | None = None,
                     tx_partitions: tuple | None = None, log_partitions: tuple | None = None) -> PartialStore:
    """(Re)write the partials of the months holding ``days`` (ISO dates), changed or not; all when None."""
    months = None if days is None else _months([dt.date.fromisoformat(d) for d in days])
    _commit(store.open(transactions.sparkSession), [(TX, transactions, tx_partitions, months), (LOGS, user_logs, log_partitions, months)])
    return store


def changed_days(store: PartialStore, transactions: DataFrame, user_logs: DataFrame,
                 tx_partitions: tuple | None = None, log_partitions: tuple | None = None) -> DataFrame:
    """(table_name, day, change, rows_before, rows_now): where the tables differ from what the partials were made of."""
    held = store.open(transactions.sparkSession).latest()
    found = []
    for kept, frame, partitions in ((TX, transactions, tx_partitions), (LOGS, user_logs, log_partitions)):
        now = day_digests(frame.drop(*(partitions or ())), kept.day)
        found.append(compare_days(held.read(kept.digests), now).select(F.lit(kept.table).alias("table_name"), "*"))
    return found[0].unionByName(found[1])


def refresh_changed(store: PartialStore, transactions: DataFrame, user_logs: DataFrame,
                    tx_partitions: tuple | None = None, log_partitions: tuple | None = None) -> dict:
    """Bring the partials up to date with the tables; returns the months rewritten for each table.

    A store that was never loaded is loaded whole.
    """
    held = store.open(transactions.sparkSession)
    try:
        held.read(TX.digests)
    except NotCommitted:
        refresh_partials(store, transactions, user_logs, None, tx_partitions, log_partitions)
        return {TX.table: None, LOGS.table: None}
    found = changed_days(store, transactions, user_logs, tx_partitions, log_partitions)
    months = found.select("table_name", F.year("day").alias("y"), F.month("day").alias("m")).distinct().collect()  # months of a calendar
    rewritten = {t: sorted((r["y"], r["m"]) for r in months if r["table_name"] == t) for t in (TX.table, LOGS.table)}
    _commit(held, [(TX, transactions, tx_partitions, rewritten[TX.table]), (LOGS, user_logs, log_partitions, rewritten[LOGS.table])])
    return rewritten


# ----------------------------------------------------------------- features
def _windowed(store: Snapshot, kept: Kept, cutoff: str, days: int) -> DataFrame:
    months = [_part(m) for m in asof.window_months(cutoff, days)]
    return asof.asof_window(store.read(kept.daily, months), kept.day, cutoff, days)


def features_from_partials(spark: SparkSession, store: PartialStore, labels: DataFrame, members: DataFrame,
                           cutoff: str, tx_days: int = CONFIG.transaction_days,
                           log_days: int = CONFIG.listening_days) -> DataFrame:
    """B5 from the stored partials: only the window's months are opened."""
    c = F.lit(cutoff).cast("date")
    held = store.open(spark).latest()
    tx = asof.merge_transaction_partials(_windowed(held, TX, cutoff, tx_days), cutoff, tx_days)
    lg = asof.merge_listening_partials(_windowed(held, LOGS, cutoff, log_days), cutoff, log_days)
    membership = members.select(
        "msno", F.datediff(c, F.col("registration_date")).alias("membership_tenure_days"))
    return feature_join(labels, membership, tx, lg)
