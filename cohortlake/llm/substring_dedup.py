"""Substring dedup: content-defined chunks, deduplicated by digest.

Every word start has a hash of its word and the ``CONTEXT`` words before.  A
cut is a word start with the least hash of some ``WINDOW`` neighbouring ones
of its text (of equal ones the last), so a chunk has at most ``WINDOW`` words,
8 on average, and a cut depends on no other cut: two copies of a passage have
the same cuts from its first whole window's least hash to its last one's,
whatever stands around them.  All but ``CONTEXT + 2 * WINDOW - 1`` words of a
passage at most lie between these.

A unit is the chunks from a cut to the first cut (or the text's end) at least
``run_words`` words on.  A unit that occurs more than once in the corpus (other
documents or the same one) is repeated; overlapping repeated units make up a
repeated passage, so all of its words lie in ``run_words`` or more words that
occur again as a whole.  A shared passage of over 50 words always holds such a
unit.  The first occurrence of each unit by (doc_id, place) stays; a passage's
words that are in no such unit are removable.

The hashes are computed for whole slices of texts at once in numpy.  Units are
dealt by digest once to count them, with map-side sums; only rows of repeated
units go on.

Defined cases: null, empty and blank texts have no chunks; a null doc_id sorts
before all; rows equal in doc_id and text are copies of each other and share
one result row; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortlake.llm.common import free_name, sliced, stored, utf8

RUN_WORDS = 20
# CONTEXT + 2 * WINDOW - 1 + RUN_WORDS = 51: the least length of a shared passage that surely holds a unit.
WINDOW, CONTEXT = 15, 2
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
GAP = b"\n" * 32
GEAR = np.random.default_rng(1).integers(0, 2**64, 256, dtype=np.uint64)
GEAR[BLANK] = 0
POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash at each word start: of the word's bytes and the ``CONTEXT`` words before it."""
    place = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(data)]])))
    own = np.add.reduceat(GEAR[data] * POWERS[place & (len(POWERS) - 1)], starts)
    h = own.copy()
    for k in range(1, CONTEXT + 1):
        h[k:] += own[:-k] * POWERS[2 * k]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def least_of_windows(h: np.ndarray) -> np.ndarray:
    """Whether an entry is the least (of equal ones the last) of some ``WINDOW`` neighbouring ones."""
    cut = np.zeros(len(h), bool)
    if len(h) >= WINDOW:
        views = np.lib.stride_tricks.sliding_window_view(h[::-1], WINDOW)
        cut[len(h) - 1 - np.arange(len(views)) - views.argmin(axis=1)] = True
    return cut


def chunks(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, words) byte spans of the chunks of one text, from word start to word start."""
    return chunk_texts([text])[0]


def chunk_texts(texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    # Gaps hold no words; their blanks end each text's last word.
    joined = np.frombuffer(GAP + b"".join(t + GAP for t in texts), np.uint8)
    blank = BLANK[joined]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    hashes = word_hashes(joined, starts) if len(starts) else np.zeros(0, np.uint64)
    bases = len(GAP) + np.cumsum([0] + [len(t) + len(GAP) for t in texts])
    bounds = np.searchsorted(starts, bases)
    out = []
    for k, text in enumerate(texts):
        lo, hi, base = int(bounds[k]), int(bounds[k + 1]), int(bases[k])
        # A text's first words have other words before them: no cut there but the first.
        cuts = [lo, *(np.flatnonzero(least_of_windows(hashes[lo + CONTEXT : hi])) + lo + CONTEXT).tolist(), hi]
        if hi == lo:
            out.append([])
            continue
        places = [*(starts[cuts[:-1]] - base).tolist(), len(text)]
        out.append([(places[i], places[i + 1], cuts[i + 1] - cuts[i]) for i in range(len(cuts) - 1)])
    return out


def units(found: list[tuple[int, int, int]], digests: list[bytes], run_words: int) -> list[tuple[int, int, int, int, bytes]]:
    """(start, end, first word, words, digest) of the units of one text's chunks."""
    made, j, held, at = [], 0, 0, 0
    for i, (start, _, words) in enumerate(found):
        while held < run_words and j < len(found):
            held += found[j][2]
            j += 1
        if held < run_words:
            break
        made.append((start, found[j - 1][1], at, held, xxhash.xxh3_128_digest(b"".join(digests[i:j]))))
        held -= words
        at += words
    return made


def unit_table(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, key, digest, places) of the units of every text; key is a hash of the text.

    ``places`` (start, end, at, words) lists all places of a unit in the text in
    order: a word repeated many times is one row.  Offsets are UTF-8 bytes, at is
    the first word's number.
    """

    def run(batches):
        for batch in sliced(batches, "text", 1 << 20):
            texts = utf8(batch, "text")
            lowered = [t.lower() for t in texts]  # A-Z only, so offsets stay
            found = []
            for t, x in zip(lowered, chunk_texts(lowered)):
                digests = [xxhash.xxh3_128_digest(b" ".join(t[s:e].split())) for s, e, _ in x]
                places: dict[bytes, list] = {}
                for *place, digest in units(x, digests, run_words):
                    places.setdefault(digest, []).append(place)
                found.append(places)
            sizes = [len(x) for x in found]
            ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            keys = np.repeat(np.array([text_key(t) for t in texts], np.int64), sizes)
            lists = [p for x in found for p in x.values()]
            spans = np.array([p for x in lists for p in x], np.int32).reshape(-1, 4)
            structs = pa.StructArray.from_arrays([pa.array(spans[:, k]) for k in range(4)], ["start", "end", "at", "words"])
            places = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(x) for x in lists]), pa.int32()), structs)
            digests = pa.array([d for x in found for d in x], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys), digests, places], ["doc_id", "key", "digest", "places"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, "doc_id long, key long, digest binary, places array<struct<start: int, end: int, at: int, words: int>>")


def text_key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def repeated_passages(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, key, start, end, words, first_words) of every repeated passage.

    ``first_words`` of its words lie in units whose first occurrence this is.
    """
    # Both sides of the joins are written tables, so that a hot digest's partition can be split.
    found = stored(unit_table(docs, run_words), "units", compression="zstd")
    known = found.groupBy("digest").agg(F.sum(F.size("places")).alias("n")).where("n > 1").select("digest")
    again = stored(found.join(stored(known, "repeated-digests"), "digest"), "repeated")
    place = F.struct("doc_id", "key", "start")
    firsts = again.groupBy("digest").agg(F.min(F.struct("doc_id", "key", F.col("places")[0]["start"].alias("start"))).alias("first"))
    marked = again.join(stored(firsts, "first-places"), "digest").select("doc_id", "key", "first", F.inline("places")).select("doc_id", "key", "start", "end", "at", "words", place.eqNullSafe(F.col("first")).alias("is_first"))
    # All units of a document in one task: repeated rows fall together, runs are told by overlapping spans.
    dealt = marked.repartition("doc_id", "key").dropDuplicates(["doc_id", "key", "start"])
    order = Window.partitionBy("doc_id", "key").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.col("at") + F.col("words")
    # Ends grow with starts; of a first unit count the words that no first unit before it holds.
    own = F.when(F.col("is_first"), last - F.greatest("at", F.coalesce(F.max(F.when(F.col("is_first"), last)).over(before), F.lit(0)))).otherwise(0)
    begins = F.when(F.lag("end").over(order) > F.col("start"), 0).otherwise(1)
    runs = dealt.withColumns({"begins": begins, "own": own}).withColumn("run", F.sum("begins").over(order)).groupBy("doc_id", "key", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max(last) - F.min("at")).alias("words"), F.sum("own").alias("first_words"),
    )
    return runs.drop("run")


def substring_dedup(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_passages, repeated_words, removable_words, spans, has_repeats.

    ``spans`` lists ``start:end`` (UTF-8 bytes) of the repeated passages.
    """
    per = repeated_passages(docs, run_words).groupBy("doc_id", "key").agg(
        F.count("*").alias("n_passages"), F.sum("words").alias("repeated_words"), F.sum(F.col("words") - F.col("first_words")).alias("removable_words"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    every = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_keys, "doc_id long, key long, n_words long").distinct()
    held = every.alias("e").join(per.alias("p"), F.col("e.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("e.key") == F.col("p.key")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_passages", "repeated_words", "removable_words")]
    listed = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return held.select("e.doc_id", F.col("e.key").alias("text_key"), "n_words", *counts, F.coalesce(listed, F.lit("")).alias("spans"), F.col("p.key").isNotNull().alias("has_repeats"))


def _keys(batches):
    for batch in sliced(batches, "text"):
        texts = utf8(batch, "text")
        made = [batch.column("doc_id"), pa.array([text_key(t) for t in texts], pa.int64()), pa.array([len(t.split()) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(made, names=["doc_id", "key", "n_words"])


def remove_repeats(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text`` wherever none of their units occurs for the first time."""
    gone = repeated_passages(docs, run_words).where("first_words = 0").groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cut"))
    schema, own_key, own_spans = docs.schema, free_name(docs, "key"), free_name(docs, "spans")

    def keyed(batches):
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([text_key(t) for t in utf8(batch, "text")], pa.int64())], names=[*batch.schema.names, own_key])

    def cut(batches):
        for batch in sliced(batches, "text"):
            texts = utf8(batch, "text")
            for i, spans in enumerate(batch.column(own_spans).to_pylist()):
                for span in reversed(spans or ()):
                    texts[i] = texts[i][: span["start"]] + texts[i][span["end"] :]
            columns = dict(zip(batch.schema.names, batch.columns))
            text = pa.array(texts, pa.binary()).cast(pa.string())
            columns["text"] = pa.compute.if_else(pa.compute.is_null(columns["text"]), pa.nulls(len(texts), pa.string()), text).cast(columns["text"].type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in schema.fieldNames()], names=schema.fieldNames())

    with_key = docs.mapInArrow(keyed, StructType([*schema.fields, StructField(own_key, LongType())]))
    held = with_key.alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col(f"d.`{own_key}`") == F.col("g.key")), "left")
    return held.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col("g.cut").alias(own_spans)).mapInArrow(cut, schema)
