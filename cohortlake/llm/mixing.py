"""Mixing sources to target weights, with DataFrame functions only.

Targets: sources in code point order (null last) take the weights in turn and
share ``share_percent`` of all words; a target stops at ``cap`` times its
source's words, and what is left over is shared again by weight.  That is the
water level ``L`` with ``sum(min(cap * size, L * weight)) = share``, found with
running sums over one row per source.

Draws: the documents of a source are dealt by hash into blocks of about
``block_docs`` documents.  A target of ``q`` times the source and a rest gives
``q`` draws of every block and one more of the first blocks, in a permuted
order, that fit into the rest; the block on the border gives the documents, in
a permuted order, that come nearest to it.  So no document is drawn more than
``cap`` times, and a hot source is only more blocks.

Shards: a splitting tree parts the block quotas of all sources among the
output shards.  Each node halves its shards and draws the left half's quotas
from its own without replacement (multivariate hypergeometric), by an urn of
hashed uniform numbers.  A shard then owns a run of each source's permuted
draws, disjoint from those of all others, and is shuffled by hash locally.

All random numbers are hashes of ``seed`` and of ids, so reruns agree and lost
tasks can be repeated.  One row per source is ordered in one task, and the
quotas of all sources are one row while the tree splits them; nothing else is.

Defined cases: null texts, empty and blank ones have size 0 and target nothing;
a null source is a source of its own; null doc_ids are mixed as others; repeated
rows are drawn together; further columns are kept by ``mix``, whose own
columns replace columns of the same names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlake.llm.common import stored, word_count

WEIGHTS = (3, 1, 2)
ADDED = ("shard", "draw", "slot")


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with a key of the source that is never null, and the document's hash."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return docs.withColumns({"__key": key, "__h": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))})


def _uniform(*parts) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def source_targets(sized: DataFrame, weights=WEIGHTS, share_percent: int = 150, cap: int = 2, block_docs: int = 1000) -> DataFrame:
    """One row per source: __key, source, source_size, target, n_blocks."""
    totals = sized.groupBy("__key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = totals.withColumn("weight", F.array(*[F.lit(float(w)) for w in weights])[F.pmod(place - 1, F.lit(len(weights)))])
    weighed = weighed.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    every = Window.partitionBy()
    lower = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    sure = lambda c: F.coalesce(F.sum(c).over(lower), F.lit(0.0))
    # The level if the sources below are at their caps; it rises up to the true one and falls after it.
    level = (F.sum("source_size").over(every) * share_percent / 100 - sure("most")) / (F.sum("weight").over(every) - sure("weight"))
    leveled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(every))
    blocks = F.greatest(F.ceil(F.col("docs") / block_docs), F.lit(1)).cast("long")
    return leveled.select("__key", "source", "source_size", F.least("most", F.col("level") * F.col("weight")).alias("target"), blocks.alias("n_blocks"))


def block_plan(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """One row per block: __key, __block, draws (whole) and cutoff (hash up to which documents are drawn once more, or null)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    wanted = sources.select("__key", "n_blocks", whole.alias("whole"), (F.col("target") - whole * F.col("source_size")).alias("rest"))
    placed = sized.join(wanted, "__key").withColumn("__block", F.pmod("__h", "n_blocks"))
    blocks = placed.groupBy("__key", "__block", "whole", "rest").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("__key").orderBy(F.xxhash64(F.lit(seed), "__key", "__block"), "__block")
    blocks = stored(blocks.withColumn("left", F.col("rest") - (F.sum("words").over(order) - F.col("words"))).drop("rest"), "blocks")
    fits = F.col("left") >= F.col("words")

    border = blocks.where(~fits & (F.col("left") > 0)).select("__key", "__block", "left")
    single = placed.select("__key", "__block", "size", F.xxhash64("__h").alias("g")).join(border, ["__key", "__block"]).groupBy("__key", "__block", "left", "g").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("__key", "__block").orderBy("g"))
    cut = single.withColumn("upto", upto).where("2 * upto - words <= 2 * left").groupBy("__key", "__block").agg(F.max("g").alias("cutoff"))
    return blocks.join(cut, ["__key", "__block"], "left").select("__key", "__block", (F.col("whole") + F.when(fits & (F.col("words") > 0), 1).otherwise(0)).alias("draws"), "cutoff")


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, __key, n) from (__key, n): exact quotas, parted among ``shards`` by the splitting tree."""
    nodes = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("__key", "n"))).alias("q")).select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "q")
    count = lambda q: F.aggregate(q, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    long = lambda v: F.lit(v).cast("long")

    def urn(state, source):
        """Draw each of a source's blocks to the left with the share of places left there."""
        def step(s, t):
            goes = F.when(_uniform(F.lit(seed), F.col("lo"), F.col("hi"), source["__key"], t) * s["rest"] < s["left"], long(1)).otherwise(long(0))
            return F.transform(F.array(goes), lambda g: F.struct((s["left"] - g).alias("left"), (s["rest"] - 1).alias("rest"), (s["got"] + g).alias("got")))[0]

        start = F.struct(state["left"].alias("left"), state["rest"].alias("rest"), long(0).alias("got"))
        steps = F.when(source["n"] > 0, F.sequence(long(1), source["n"])).otherwise(F.array().cast("array<bigint>"))
        drawn = F.aggregate(steps, start, step)
        return F.transform(F.array(drawn), lambda d: F.struct(d["left"].alias("left"), d["rest"].alias("rest"), F.concat(state["out"], F.array(F.struct(source["__key"].alias("__key"), d["got"].alias("n")))).alias("out")))[0]

    for _ in range(max(0, math.ceil(math.log2(shards)))):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        nodes = nodes.withColumns({"mid": mid, "total": count(F.col("q"))})
        places = F.floor(F.col("total") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")
        start = F.struct(places.alias("left"), F.col("total").alias("rest"), F.array().cast("array<struct<__key:string,n:bigint>>").alias("out"))
        nodes = nodes.withColumn("l", F.aggregate("q", start, urn, lambda s: s["out"]))
        right = F.zip_with("q", "l", lambda a, b: F.struct(a["__key"].alias("__key"), (a["n"] - b["n"]).alias("n")))
        node = lambda lo, hi, q: F.struct(lo.alias("lo"), hi.alias("hi"), q.alias("q"))
        halves = F.array(node(F.col("lo"), F.col("mid"), F.col("l")), node(F.col("mid"), F.col("hi"), right))
        one = F.array(node(F.col("lo"), F.col("hi"), F.col("q")))
        nodes = nodes.select(F.explode(F.when(F.col("hi") - F.col("lo") > 1, halves).otherwise(one)).alias("x")).select("x.*")
    return nodes.select(F.col("lo").alias("shard"), F.explode("q").alias("x")).select("shard", "x.__key", "x.n")


def block_draws(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """One row per draw of a block: __key, __block, draw, cutoff (null: the whole block), shard."""
    draws = F.transform(F.sequence(F.lit(0).cast("long"), F.col("draws")), lambda i: F.struct(i.alias("draw"), F.when(i == F.col("draws"), F.col("cutoff")).alias("cutoff"), ((i < F.col("draws")) | F.col("cutoff").isNotNull()).alias("is")))
    each = plan.select("__key", "__block", F.explode(draws).alias("d")).select("__key", "__block", "d.*").where("is").drop("is")
    order = Window.partitionBy("__key").orderBy(F.xxhash64(F.lit(seed + 1), "__key", "__block", "draw"), "__block", "draw")
    ranked = stored(each.withColumn("rank", F.row_number().over(order).cast("long")), "draws")
    quotas = ranked.groupBy("__key").agg(F.count("*").alias("n"))
    split = stored(split_quotas(quotas, shards, seed + 2), "quotas")
    upto = F.sum("n").over(Window.partitionBy("__key").orderBy("shard"))
    runs = split.withColumn("upto", upto).select("__key", "shard", (F.col("upto") - F.col("n")).alias("after"), "upto")
    return ranked.join(runs, "__key").where("rank > after and rank <= upto").select("__key", "__block", "draw", "cutoff", "shard")


class Mixture:
    """The plan of a mixture of ``docs`` (doc_id, text, source, ...): targets, block draws and shards."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, share_percent: int = 150, cap: int = 2, block_docs: int = 1000, shards: int = 8, seed: int = 6):
        self.docs = docs.drop(*ADDED)
        self.seed = seed
        keyed = _keyed(docs.select("doc_id", F.col("source").cast("string"), F.col("text").cast("string")), seed)
        self.sized = stored(keyed.select("doc_id", "source", "__key", "__h", word_count(F.col("text")).alias("size")), "sizes")
        self.sources = stored(source_targets(self.sized, weights, share_percent, cap, block_docs), "sources")
        self.plan = stored(block_plan(self.sized, self.sources, seed), "plan")
        self.draws = stored(block_draws(self.plan, shards, seed), "block-draws")

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) of every document, from the draws of its block."""
        times = self.draws.groupBy("__key", "__block").agg(F.count(F.when(F.col("cutoff").isNull(), 1)).alias("times"), F.max("cutoff").alias("cutoff"))
        placed = self.sized.join(self.sources.drop("source"), "__key").withColumn("__block", F.pmod("__h", "n_blocks"))
        held = placed.join(times, ["__key", "__block"], "left")
        drawn = F.coalesce("times", F.lit(0)) + F.when(F.xxhash64("__h") <= F.col("cutoff"), 1).otherwise(0)
        return held.select("doc_id", "size", "source_size", "target", (F.col("size") * drawn).cast("long").alias("taken"))

    def rows(self) -> DataFrame:
        """The drawn documents, a row each time, with shard, draw and slot (order within the shard)."""
        # Own columns of the plan begin with two underscores; those of the documents take other names meanwhile.
        held = [c if c in ("doc_id", "text", "source") else f"__c{i}" for i, c in enumerate(self.docs.columns)]
        placed = _keyed(self.docs.toDF(*held), self.seed).join(self.sources.select("__key", "n_blocks"), "__key").withColumn("__block", F.pmod("__h", "n_blocks"))
        drawn = placed.join(self.draws, ["__key", "__block"]).where(F.col("cutoff").isNull() | (F.xxhash64("__h") <= F.col("cutoff")))
        slot = F.xxhash64(F.lit(self.seed), "shard", "draw", "__h")
        mixed = drawn.withColumn("slot", slot).repartition(F.col("shard"), F.pmod("slot", F.lit(64))).sortWithinPartitions("shard", "slot")
        return mixed.select(*[F.col(h).alias(c) for h, c in zip(held, self.docs.columns)], *ADDED)
