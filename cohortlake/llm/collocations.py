"""Phrase collocations from a weighted de Bruijn graph of words.

Edges are the longest grams (``WIDTH`` words), nodes the grams of a word less.
Every word begins exactly one gram: the longest one, or, near the end of its
piece, what is left of the piece.  The first are the edges, the others the
piece-end corrections.  Their counts are summed once over the corpus; all shorter
counts follow from the flow through the graph, f(node) = the weights of its
outgoing edges + the pieces that end with it, one length after the other.

A node whose whole flow leaves by one edge, or comes in by one, is a unary link:
the shorter phrase never stands without the longer one.  Compacting these links
is what drops a candidate inside a longer phrase of the same count (a phrase of
the same count that is longer by more words goes through one longer by one word).

Scale.  Most grams of a corpus are rare, and no rare one can be part of a
candidate.  So a first pass counts word pairs in ``2 ** filter_bits`` hash
buckets; a bucket below the least count proves that all of its pairs are rare,
and pieces are cut between their words too, as at their ends.  A candidate and its parts
never hold such a pair, so their counts stay exact, and what is shuffled are the
single words and the grams of the frequent stretches, summed in every task first.  The filter is a
bitmap of fixed size (16 MB at 27 bits), the only thing collected and broadcast.  It
tells less and less from about 2 ** filter_bits * min_count / 2 words on; results
do not depend on it, only the shuffle, which without it has one gram a word.
Counts and scores are integers and decimals of 38 digits.

Defined cases: a null text has no words, a null language is ``und`` (as are texts
so named); repeated rows count each time; texts of any length are read whole,
in slices, and a text is never cut between slices.  An empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from cohortlake.llm.common import sliced, stored, utf8

WIDTH = 5
UNKNOWN = "und"
#: Lower case of A-Z; separators of pieces become line ends, those of words blanks.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
#: Bytes of text that a task counts at once, and rows that it hands on at once; both bound its memory.
SLICE, ROWS = 6 << 20, 50_000
#: Words that a task numbers before it begins again, which bounds its memory.
MOST_WORDS = 2_000_000
#: Buckets of a block of the filter.
BLOCK_BITS = 16


class Words:
    """Numbers of words, and a 64-bit hash for each; number 0 is no word."""

    def __init__(self):
        self.numbers = defaultdict(count(1).__next__)
        self.words, self.hashes = [b""], np.zeros(1, np.uint64)

    def read(self, texts: list[bytes]) -> np.ndarray:
        """The words of the texts in order, 0 after each piece."""
        number, out = self.numbers.__getitem__, array("q")
        for text in texts:
            for piece in text.translate(FOLD).split(b"\n"):
                words = piece.split()
                if words:
                    out.extend(map(number, words))
                    out.append(0)
        new = list(islice(self.numbers, len(self.words) - 1, None))
        if new:
            self.words += new
            self.hashes = np.concatenate([self.hashes, np.fromiter((xxhash.xxh3_64_intdigest(w) for w in new), np.uint64, len(new))])
        return np.frombuffer(out, np.int64)

    def pair_buckets(self, stream: np.ndarray, lang: bytes, bits: int) -> np.ndarray:
        """Bucket of each word with the next."""
        h = self.hashes[stream] ^ np.uint64(xxhash.xxh3_64_intdigest(lang))
        pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


def _by_language(batches):
    """(language, its words in a slice of texts, their numbers)."""
    words = Words()
    for batch in sliced(batches, "text", SLICE):
        if len(words.words) > MOST_WORDS:
            words = Words()
        langs = batch.column("lang").to_pylist()
        texts = utf8(batch, "text")
        for lang in sorted(set(langs)):
            stream = words.read([t for t, own in zip(texts, langs) if own == lang])
            if len(stream):
                yield lang, stream, words


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))


# ------------------------------------------------------------------ filter
def _filter(texts: DataFrame, bits: int, least: int) -> bytes:
    """Bitmap of the buckets that hold ``least`` pairs of words or more."""
    size = 1 << BLOCK_BITS

    def counted(batches):
        for lang, stream, words in _by_language(batches):
            pairs = words.pair_buckets(stream, lang.encode(), bits)
            at, n = np.unique(pairs[(stream[:-1] > 0) & (stream[1:] > 0)], return_counts=True)
            blocks, starts = np.unique(at >> BLOCK_BITS, return_index=True)
            ends = np.append(starts[1:], len(at))
            made = [np.stack([(at[i:j] & (size - 1)).astype(np.uint32), n[i:j].astype(np.uint32)]).tobytes() for i, j in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(made, pa.binary())], names=["block", "counts"])

    def summed(batches):
        at, sums = None, np.zeros(size, np.int64)
        for batch in batches:
            made = []
            for block, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                if block != at:
                    made += [(at, np.packbits(sums >= least).tobytes())] if at is not None else []
                    at, sums = block, np.zeros(size, np.int64)
                where, n = np.frombuffer(data, np.uint32).reshape(2, -1)
                sums[where] += n
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in made], pa.int32()), pa.array([m for _, m in made], pa.binary())], names=["block", "bits"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], names=["block", "bits"])

    blocks = texts.mapInArrow(counted, "block int, counts binary").repartition("block").sortWithinPartitions("block").mapInArrow(summed, "block int, bits binary")
    out = bytearray(1 << bits >> 3)
    for block, part in blocks.collect():  # 2 ** (bits - 3) bytes at most
        out[block * size >> 3 : (block + 1) * size >> 3] = part
    return bytes(out)


# ------------------------------------------------------------------ grams
def cut_grams(stream: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, length, count) of the distinct grams that begin at words; ``links[i]``: word i and the next may be in one gram."""
    n = len(stream)
    left = np.ones(n, np.int64)  # words from here that are linked, up to the width
    for _ in range(width - 1):
        left[:-1] = np.where(links, np.minimum(left[1:] + 1, width), 1)
    starts = np.flatnonzero(stream > 0)
    padded = np.append(stream, np.zeros(width, np.int64))
    name = padded[starts]
    for k in range(1, width):  # names of grams of k + 1 words from those of k
        more = np.where(left[starts] > k, padded[starts + k], 0)
        base = int(more.max(initial=0)) + 1
        _, name = np.unique(name * base + more, return_inverse=True)
    _, first, n_of = np.unique(name, return_index=True, return_counts=True)
    return starts[first], left[starts[first]], n_of


def _grams(texts: DataFrame, width: int, bits: int, bitmap) -> DataFrame:
    """(lang, gram, k, n): the counted grams, and for each language its words (k = 0)."""

    def run(batches):
        frequent = np.frombuffer(bitmap.value, np.uint8)

        def holds(buckets):
            return (frequent[buckets >> 3] >> (7 - (buckets & 7)).astype(np.uint8) & 1).astype(bool)

        for lang, stream, words in _by_language(batches):
            links = (stream[:-1] > 0) & (stream[1:] > 0) & holds(words.pair_buckets(stream, lang.encode(), bits))
            at, length, n = cut_grams(stream, links, width)
            yield counted(lang, [b""], [0], [int((stream > 0).sum())])
            for some in np.split(np.arange(len(at)), range(ROWS, len(at), ROWS)):
                grams = [b" ".join([words.words[w] for w in stream[i : i + k]]) for i, k in zip(at[some].tolist(), length[some].tolist())]
                yield counted(lang, grams, length[some], n[some])

    def counted(lang, grams, k, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.binary()).cast(pa.string()), pa.array(k, pa.int32()), pa.array(n, pa.int64())], names=["lang", "gram", "k", "n"])

    return texts.mapInArrow(run, "lang string, gram string, k int, n long")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100, width: int = WIDTH, filter_bits: int = 27) -> DataFrame:
    """(lang, phrase, k, f) of all phrases of 1 to ``width`` words with f >= min_count, and each language's words as k = 0; a written table."""
    spark = docs.sparkSession
    texts = _texts(docs, text_col, lang_col)
    bitmap = spark.sparkContext.broadcast(_filter(texts, filter_bits, min_count))
    grams = stored(_grams(texts, width, filter_bits, bitmap).groupBy("lang", "gram", "k").agg(F.sum("n").alias("n")), "phrase-grams")
    bitmap.destroy()
    flow = grams.where(F.col("k") == width).select("lang", "gram", "n")
    levels = [grams.where("k = 0"), flow.where(F.col("n") >= min_count).withColumn("k", F.lit(width))]
    for k in range(width - 1, 0, -1):
        ends = grams.where(F.col("k") == k).select("lang", "gram", "n")
        flow = flow.select("lang", F.substring_index("gram", " ", k).alias("gram"), "n").unionByName(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        flow = stored(flow, f"phrase-flow-{k}")
        levels.append(flow.where(F.col("n") >= min_count).withColumn("k", F.lit(k)))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return stored(out.select("lang", F.col("gram").alias("phrase"), "k", F.col("n").alias("f")), "phrase-counts")


# ------------------------------------------------------------------ candidates
def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100, top: int = 2000, width: int = WIDTH, filter_bits: int = 27) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, count, text."""
    counts = phrase_counts(docs, text_col, lang_col, min_count, width, filter_bits)
    found = counts.where("k >= 2")
    # Unary links: the words before the last and those after the first, by the counts of the longer phrase.
    longer = found.where("k >= 3").select("lang", "f", F.explode(F.array(F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))).alias("phrase"))
    inside = stored(longer.groupBy("lang", "phrase").agg(F.max("f").alias("most")), "phrase-inside")
    open_ = found.join(inside, ["lang", "phrase"], "left").where("most IS NULL OR 100 * most < 100 * f").drop("most")
    cuts = open_.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', cut)").alias("head"), F.expr("substring_index(phrase, ' ', cut - k)").alias("tail"))
    part = counts.where(F.col("k").between(1, width - 1))
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    words = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    scored = cuts.join(words, "lang").withColumn("score", F.expr("(CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * r)"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "n", "best.score", "best.l", "best.r").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
