"""Members as a mergeable state: the latest registration of each subscriber.

The state of a subscriber is the largest (registration date, raw registration text)
of its valid rows, nulls least, which is what ordering by both, descending with nulls
last, puts first.  A maximum merges: of parts of a table in any order, of rows that
come twice.  So a delivery of member rows is reduced to states by itself (combined
in every task; a hot subscriber is one row a task) and merged into the stored ones.

States lie in ranges of the key's hash, each an entry of a committed store.  A merge
joins the delivery's states to the stored ones of the same ranges, finds those that
are new or larger, and rewrites only ranges that hold one, as one commit.  A delivery
that brings nothing new commits nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlake.config import CONFIG
from cohortlake.operators.quality import keep_valid
from cohortlake.plans.committed import NotCommitted, Store

KEY = CONFIG.key
ORDER = ("registration_date", "registration_init_time")
RELATION, LAYER, RANGE = "member_states", "member_states", "p_range"


def member_states(typed_members: DataFrame) -> DataFrame:
    """(key, registration_date, registration_init_time): the state of each valid key of some member rows."""
    return merged_states(keep_valid(typed_members, "members_v3").select(KEY, *ORDER))


def merged_states(states: DataFrame) -> DataFrame:
    return states.groupBy(KEY).agg(F.max(F.struct(*ORDER)).alias("latest")).select(KEY, "latest.*")


@dataclass(frozen=True)
class MemberStore:
    """``ranges`` is fixed for the life of a store."""

    base: str
    ranges: int = 256

    def open(self, spark: SparkSession) -> Store:
        return Store(spark, self.base)

    def _ranged(self, states: DataFrame) -> DataFrame:
        return states.withColumn(RANGE, F.pmod(F.xxhash64(KEY), F.lit(self.ranges)).cast("int"))

    def merge(self, typed_members: DataFrame) -> list[int]:
        """Merge a delivery of typed member rows; returns the ranges that were rewritten."""
        store = self.open(typed_members.sparkSession)
        new = self._ranged(member_states(typed_members))
        try:
            held = store.read(RELATION, layer=LAYER)
        except NotCommitted:
            self._write(store, new)
            return list(range(self.ranges))
        old = self._ranged(held).select(KEY, RANGE, F.struct(*ORDER).alias("old"))
        latest = F.struct(*ORDER)
        changed = new.join(old, [KEY, RANGE], "left").where(F.col("old").isNull() | (latest > F.col("old")))
        ranges = sorted(r[0] for r in changed.select(RANGE).distinct().collect())  # at most self.ranges numbers
        if ranges:
            parts = [f"{RANGE}={r}" for r in ranges]
            kept = store.read(RELATION, parts, LAYER).select(KEY, *ORDER)
            moved = new.where(F.col(RANGE).isin(ranges)).select(KEY, *ORDER)
            self._write(store, self._ranged(merged_states(kept.unionByName(moved))))
        return ranges

    def _write(self, store: Store, states: DataFrame) -> None:
        dealt = states.hint("rebalance", RANGE).sortWithinPartitions(RANGE, KEY)
        store.commit(store.write_parts(RELATION, dealt, (RANGE,), LAYER))

    def members(self, spark: SparkSession) -> DataFrame:
        """C2 from the states: (key, registration_date)."""
        return self.open(spark).read(RELATION, layer=LAYER).select(KEY, "registration_date")
