"""MinHash near-duplicate detection with tensored banding.

Two collections of ``bands`` small keys are made per document, each from
``rows`` minhashes.  A table key combines one key of either collection, so
``bands ** 2`` tables of ``2 * rows`` hashes each need only
``2 * bands * rows`` minhashes instead of ``2 * bands ** 2 * rows``.  Two sets
of similarity ``t`` miss every table with probability below
``2 * (1 - t ** rows) ** bands``; ``bands`` is the smallest number that keeps
this below ``miss`` at the threshold.  More ``rows`` make a table key more
selective; larger collections of alike documents want more.

Work flow, all of it Spark jobs over tables in the shared scratch folder:

1. one pass over the texts gives set size, set digest and small keys;
2. documents of equal sets are one node from here on (hot groups of copies
   shrink in the map-side aggregation);
3. nodes are dealt out by table key; keys that one node alone holds go;
4. nodes whose shingles are mostly their own can link with nothing: a link at
   ``t`` needs ``t`` of the shingles of either side in both (exact);
5. links are confirmed on the full shingle sets, in three rounds: within each
   key of the diagonal tables every node is held against one hub, then within
   each key of all tables against one hub of another component.  What is left
   are candidates of different components; these are tested on small sketches
   inside tasks of bounded blocks, which can let a pair through in error but
   never stop one, and only pairs that pass are rows and are confirmed.  A key
   that common text has filled beyond a block is refined by its nodes' rarest
   shingles, of which a linked pair shares one.  So a group of thousands of
   near copies, or of texts with a common passage, makes rows by its size, not
   its square.

Results are exact up to ``miss``: no bucket, partner or candidate is capped.

Defined cases: null, empty or blank text has no shingles and links with
nothing; fewer words than ``width`` make one shingle of the whole sequence; a
null ``doc_id`` takes part in no link (component null, kept); rows that
repeat a ``doc_id`` are rows of one document each, and share the result that
their text gets; further columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortlake.llm.common import free_name, sliced, stored, utf8

MIX = 0x9E3779B97F4A7C15
WORDS_HELD = 500_000
BLOCK = 1024
COLUMNS = 8192


def bands_for(threshold: float, rows: int, miss: float) -> int:
    """Smallest number of keys a side that keeps the miss probability below ``miss``."""
    return max(1, math.ceil(math.log(miss / 2) / math.log(1 - threshold**rows)))


class WordHashes(dict):
    """64-bit hash of each word seen, held for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fold(parts: list[np.ndarray], salt: int) -> np.ndarray:
    """One hash of several columns of hashes, in order."""
    h = scramble(parts[0] + np.uint64(salt))
    for part in parts[1:]:
        h = scramble(h * np.uint64(MIX) + part)
    return h


def shingle_sets(texts: list[bytes], width: int, words: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (lower-cased in A-Z only)."""
    split = [t.lower().split() for t in texts]
    lengths = [len(s) for s in split]
    flat = np.fromiter((words[w] for s in split for w in s), np.uint64, sum(lengths))
    rolled = fold([flat[j : len(flat) - width + 1 + j] for j in range(width)], width) if len(flat) >= width else flat[:0]
    sets, start = [], 0
    for n in lengths:
        if n >= width:
            sets.append(np.unique(rolled[start : start + n - width + 1]))
        elif n:
            sets.append(fold([flat[start + j : start + j + 1] for j in range(n)], n))
        else:
            sets.append(flat[:0])
        start += n
    return sets


def small_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(set, 2 * bands) keys, each from ``rows`` minhashes; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    seeds = np.random.default_rng(20).integers(1, 2**63, (2 * bands, rows, 2), dtype=np.uint64)
    keys = np.empty((len(sets), 2 * bands), np.uint64)
    for band in range(2 * bands):
        minima = [np.minimum.reduceat((flat ^ x) * (m * np.uint64(2) + np.uint64(1)), starts) for x, m in seeds[band]]
        keys[:, band] = fold(minima, band)
    return keys


def set_digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def text_key(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, digest, keys) of every row; digest and keys are null for empty sets."""

    def run(batches):
        words = WordHashes()
        for batch in sliced(batches, "text"):
            sets = shingle_sets(utf8(batch, "text"), width, words)
            full = [i for i, s in enumerate(sets) if len(s)]
            digests, keys = [None] * len(sets), [None] * len(sets)
            if full:
                for i, row in zip(full, small_keys([sets[i] for i in full], bands, rows).view(np.int64)):
                    digests[i], keys[i] = set_digest(sets[i]), row
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "n_shingles", "digest", "keys"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key(F.col("text")).alias("text_key"))
    return texts.mapInArrow(run, "doc_id long, text_key long, n_shingles long, digest binary, keys array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, shingles, sketch) of the given (node, digest, min_doc); the sketch is the distinct first 16 bits of the shingles."""

    def run(batches):
        words = WordHashes()
        for batch in sliced(batches, "text"):
            sets = shingle_sets(utf8(batch, "text"), width, words)
            kept = [i for i, (s, d) in enumerate(zip(sets, batch.column("digest").to_pylist())) if set_digest(s) == d]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(kept, pa.int64())), pa.array([len(sets[i]) for i in kept], pa.int64()), pa.array([sets[i].view(np.int64) for i in kept], pa.list_(pa.int64())),
                 pa.array([np.unique((sets[i] >> np.uint64(48)).astype(np.uint16)).tobytes() for i in kept], pa.binary())],
                ["node", "n", "shingles", "sketch"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("min_doc"), F.col("text").cast("string"))
    return texts.join(nodes, "min_doc").select("node", "digest", "text").mapInArrow(run, "node long, n long, shingles array<long>, sketch binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"set_{x}"))
    held = pairs.join(side("a"), "a").join(side("b"), "b")
    both = held.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("both"))
    return both.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node on an edge (a, b): the smallest node that it reaches.

    Each round takes the least label of the neighbours and then the label of
    the label, until no label changes.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = lower.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        labels = stored(lower.join(up, "comp").select("node", "old", F.col("up").alias("comp")), "labels")
        if labels.where("old <> comp").isEmpty():
            return labels.select("node", "comp")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after joining the components that the links connect."""
    a, b = (labels.select(F.col("node").alias(x), F.col("comp").alias(f"c_{x}")) for x in "ab")
    across = stored(links.join(a, "a").join(b, "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).where("a <> b").distinct(), "across")
    if across.isEmpty():
        return labels
    onto = components(across).select(F.col("node").alias("comp"), F.col("comp").alias("onto"))
    return stored(labels.join(onto, "comp", "left").select("node", F.coalesce("onto", "comp").alias("comp")), "labels")


def hub_pairs(hits: DataFrame, labels: DataFrame) -> DataFrame:
    """Within each key: the pairs of one hub and every node of another component."""
    held = hits.join(labels, "node")
    hubs = held.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node", "comp")).alias("hub"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    # Written first: beside its own aggregate a hot key's nodes could not be split in the join.
    hubs = stored(hubs.where("low <> high").select("key", F.col("hub.node").alias("hub"), F.col("hub.comp").alias("hub_comp")), "hubs")
    return held.join(hubs, "key").where("comp <> hub_comp").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()


def mixed_keys(held: DataFrame) -> DataFrame:
    """(key, c) of the keys (key, node, comp) that hold more than one component; a written table."""
    found = held.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("c")).where("low <> high")
    return stored(found.select("key", "c"), "mixed-keys")


def rare_shingles(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, comp): the rarest shingles of each node, as many as a link must share one of.

    Two sets that link have ``percent`` / 100 of either in common, so of the
    n - ceil(n * percent / 100) + 1 first shingles of each, in one order of all, one
    is common.  The order is by the number of nodes in the crowd, rarest first:
    what many of them hold by way of boilerplate comes last.
    """
    said = crowd.join(sets.select("node", "n", "shingles"), "node").select("node", "comp", "n", F.explode("shingles").alias("s"))
    counts = stored(said.groupBy("s").agg(F.count("*").alias("c")).where("c > 1"), "crowd-shingles")
    ordered = said.join(counts, "s", "left").groupBy("node", "comp", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("c", F.lit(1)).alias("c"), "s"))).alias("own"))
    first = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    prefix = ordered.select("node", "comp", F.explode(F.slice("own", F.lit(1), first)).alias("x")).where("x.c > 1")
    return prefix.select(F.xxhash64("x.s").alias("key"), "node", "comp")


def open_pairs(nodes: DataFrame, labels: DataFrame, sets: DataFrame, bands: int, percent: int) -> DataFrame:
    """The pairs of different components that share a key of the first collection and may link.

    Sharing a table key implies sharing one of these, so no candidate is left
    out.  The nodes of a key meet in one task, which tests their pairs on the
    sketches; only pairs that pass are rows.  A key with more than ``BLOCK`` nodes
    in different components is common text: its nodes meet by their rarest shingles
    instead, which is exact.  Where even such a shingle has more nodes, they are
    dealt into blocks and a task holds two.
    """
    keys = F.posexplode(F.slice("keys", 1, bands)).alias("band", "small")
    held = nodes.join(labels, "node").select("node", "comp", keys).select("node", "comp", F.xxhash64("band", "small").alias("key"))
    held = stored(held, "open-keys")
    mixed = mixed_keys(held)
    crowd = stored(held.join(mixed.where(F.col("c") > BLOCK).select("key"), "key").select("node", "comp").distinct(), "crowd")
    met = held.join(mixed.where(F.col("c") <= BLOCK).select("key", F.lit(1).cast("long").alias("blocks")), "key")
    if not crowd.isEmpty():
        rare = stored(rare_shingles(crowd, sets, percent), "rare-shingles")
        met = met.unionByName(rare.join(mixed_keys(rare).select("key", F.ceil(F.col("c") / BLOCK).alias("blocks")), "key"))
    sketches = sets.select("node", "n", "sketch")
    dealt = met.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    places = dealt.select("key", "node", "comp", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    groups = places.select("key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "node", "comp")
    sent = groups.join(sketches, "node").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def run(batches):
        at, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "p", "q", "block", "node", "comp", "n", "sketch"))):
                if row[:3] != at:
                    yield from passing(held, percent)
                    at, held = row[:3], []
                held.append(row[3:])
        yield from passing(held, percent)

    return sent.select("key", "p", "q", "block", "node", "comp", "n", "sketch").mapInArrow(run, "a long, b long").distinct()


def passing(rows: list[tuple], percent: int):
    """Batches (a, b) of the pairs of (block, node, comp, n, sketch) that may link.

    A sketch holds the distinct first 16 bits of the shingles.  A set's common
    shingles number at most the common sketch values and the smaller of the
    two numbers of shingles that share a value, so no link fails.
    """
    if len(rows) < 2:
        return
    block, node, comp, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
    if (comp == comp[0]).all():
        return
    values = [np.frombuffer(r[4], np.uint16) for r in rows]
    sizes = np.array([len(v) for v in values])
    used, column = np.unique(np.concatenate(values), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    common = np.zeros((len(rows), len(rows)), np.float32)
    for start in range(0, len(used), COLUMNS):
        some = (column >= start) & (column < start + COLUMNS)
        table = np.zeros((len(rows), min(COLUMNS, len(used) - start)), np.float32)
        table[owner[some], column[some] - start] = 1
        common += table @ table.T
    most = common + np.minimum.outer(n - sizes, n - sizes)
    may = 100 * most >= percent * (np.add.outer(n, n) - most)
    may &= comp[:, None] != comp
    if (block != block[0]).any():
        may &= block[:, None] != block
    a, b = np.nonzero(np.triu(may, 1))
    if len(a):
        a, b = node[a], node[b]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, rows: int = 3, miss: float = 1e-4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Documents link at a Jaccard similarity of ``percent`` / 100 of their sets
    of distinct ``width``-word shingles; ``component_id`` is the smallest
    doc_id reachable over links, ``kept`` marks the document that has it.
    """
    return classes(docs, width, percent, rows, miss).select("doc_id", "n_shingles", "component_id", "kept")


def classes(docs: DataFrame, width: int, percent: int, rows: int = 3, miss: float = 1e-4) -> DataFrame:
    """``near_duplicates`` with ``text_key`` of each row's text and ``comp``, the number of its component (null for empty sets)."""
    bands = bands_for(percent / 100, rows, miss)
    signed = stored(signatures(docs, width, bands, rows), "signatures")
    sets_of_words = (
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("min_doc"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    )
    nodes = stored(sets_of_words.withColumn("node", F.monotonically_increasing_id()), "nodes")

    # One row per node and table.
    pair = nodes.select("node", "keys", F.explode(F.expr(f"sequence(0, {bands * bands - 1})")).alias("t"))
    dealt = pair.select("node", F.expr(f"xxhash64(keys[t div {bands}], keys[{bands} + t % {bands}], t)").alias("key"), F.expr(f"t div {bands} = t % {bands}").alias("diagonal"))
    shared = stored(dealt.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "shared-keys")
    hits = stored(dealt.join(shared, "key"), "hits")

    active = hits.select("node").distinct().join(nodes.select("node", "digest", "min_doc"), "node")
    sets = stored(full_sets(docs, active, width), "sets")
    own = sets.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last").groupBy("node").agg(F.count("*").alias("own"))
    sizes = sets.select("node", "n").distinct()
    live = stored(sizes.join(own, "node", "left").where(100 * (F.col("n") - F.coalesce("own", F.lit(0))) >= percent * F.col("n")).select("node", "n"), "live")

    labels = live.select("node", F.col("node").alias("comp"))
    labels = merged(labels, confirmed(hub_pairs(hits.where("diagonal").select("key", "node"), labels), sets, percent))
    labels = merged(labels, confirmed(hub_pairs(hits.select("key", "node"), labels), sets, percent))
    labels = merged(labels, confirmed(open_pairs(nodes, labels, sets, bands, percent), sets, percent))

    placed = nodes.select("node", "digest", "min_doc").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = placed.groupBy("comp").agg(F.min("min_doc").alias("component_id"))
    found = stored(placed.join(least, "comp").select("digest", "component_id", "comp"), "components")
    out = signed.select("doc_id", "text_key", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", "comp", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, columns unchanged.

    Rows go by (doc_id, text): an id that stands on several texts loses those that
    are copies and keeps the others.  Of a component's rows with its smallest id,
    one text stays, and of rows that repeat both id and text, one.  Null ids stay.
    """
    found = stored(classes(docs, width, percent).where("doc_id is not null"), "near-duplicates")
    row_id, row_key = (free_name(docs, x) for x in ("id", "key"))
    names = F.col("doc_id").alias(row_id), F.col("text_key").alias(row_key)
    one = found.where("kept and comp is not null").groupBy("comp").agg(F.min("text_key").alias("first"), F.max("text_key").alias("last"))
    spare = found.where("kept").join(one.where("first <> last"), "comp").where("text_key <> first")
    gone = stored(found.where("not kept").select(*names).union(spare.select(*names)).distinct(), "gone")
    is_row = (docs["doc_id"].cast("long") == F.col(row_id)) & (text_key(docs["text"]) == F.col(row_key))
    left = docs.join(gone, is_row, "left_anti")
    again = stored(found.where("kept").groupBy(*names).count().where("count > 1").drop("count"), "repeated-rows")
    if again.isEmpty():
        return left
    return left.join(again, is_row, "left_anti").union(left.join(again, is_row, "left_semi").dropDuplicates(["doc_id", "text"]))
