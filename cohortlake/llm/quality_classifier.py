"""Quality classifier: a factorisation machine over hashed words and structure.

Inputs of a score are the words of the whole text, hashed to ``1 << BITS``
columns with unit length, statistics of its structure, and its length as the
one item of metadata.  The score is ``sigmoid(w0 + <w, x> + pairs)``, where the
sum over all pairs of inputs of ``<v_i, v_j> x_i x_j`` is half the difference
of ``|sum v_i x_i|**2`` and ``sum |v_i x_i|**2``: linear in the inputs.

Learning: a sample of at most ``max_rows`` labelled rows (those with the
least hashes of their id) is turned into inputs on the executors; only the
inputs come to the driver, where numpy fits the weights.  Scoring maps every
row, and broadcasts the weights (a fixed 2.4 MB).

Defined cases: null text is empty; empty texts get the score of their
(constant) structure; null labels and rows without a label are not learnt
from; several labels of a document count as the largest; without labels every
score is 0.5; repeated rows get equal scores; further columns are ignored or,
when filtering, kept.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortlake.llm.common import sliced, stored, utf8

BITS = 16
FACTORS = 8
SYMBOLS, MARKS, CAPITALS, DIGITS = b"#*$%&|<>", b"!?", bytes(range(65, 91)), b"0123456789"
#: Inputs after the hashed words.
STRUCTURE = ("symbols", "marks", "capitals", "digits", "word_length", "distinct_words", "duplicate_lines", "line_words", "top_word", "length")
WIDTH = (1 << BITS) + len(STRUCTURE)
MAX_ROWS = 8000


def inputs(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(columns, values) of the non-zero inputs of one text."""
    words = text.split()
    n, size = len(words), len(text)
    counts = Counter(words)
    columns = np.fromiter((zlib.crc32(w.lower()) & ((1 << BITS) - 1) for w in counts), np.int32, len(counts))
    values = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)))
    values /= max(1e-6, float(np.sqrt(np.dot(values, values))))
    share = lambda chars: (size - len(text.translate(None, chars))) / max(1, size)
    lines = [x for x in text.split(b"\n") if x.strip()]
    structure = (
        min(1, 10 * share(SYMBOLS)), min(1, 10 * share(MARKS)), share(CAPITALS), share(DIGITS),
        min(2, sum(map(len, counts)) / max(1, len(counts)) / 8), len(counts) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)),
        min(2, math.log1p(n / max(1, len(lines))) / 4), max(counts.values(), default=0) / max(1, n), math.log1p(size) / 12,
    )
    columns = np.concatenate([columns, np.arange(1 << BITS, WIDTH, dtype=np.int32)])
    return columns, np.concatenate([values, np.array(structure, np.float32)])


def margins(weights, columns: np.ndarray, values: np.ndarray, starts: np.ndarray):
    """(margin of each text, sums of its factors), texts given one after the other."""
    w0, w, v = weights
    xv = v[columns] * values[:, None]
    sums = np.add.reduceat(xv, starts, axis=0)
    pairs = 0.5 * (np.square(sums).sum(axis=1) - np.add.reduceat(np.square(xv).sum(axis=1), starts))
    return w0 + np.add.reduceat(w[columns] * values, starts) + pairs, sums


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.1, decay: float = 1e-5, seed: int = 8):
    """Weights (w0, w, v) by Adagrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    w0, w = 0.0, np.zeros(WIDTH, np.float32)
    v = rng.normal(0, 0.02, (WIDTH, FACTORS)).astype(np.float32)
    if not rows:
        return w0, w, v
    g0, gw, gv = 1e-6, np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, FACTORS), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at : at + batch]
            sizes = np.array([len(rows[i][0]) for i in some])
            columns, values = (np.concatenate([rows[i][k] for i in some]) for k in (0, 1))
            starts = np.cumsum(sizes) - sizes
            margin, sums = margins((w0, w, v), columns, values, starts)
            error = (sigmoid(margin) - labels[some]).astype(np.float32) / len(some)
            each, own = np.repeat(error, sizes), np.repeat(np.arange(len(some)), sizes)
            used, back = np.unique(columns, return_inverse=True)
            d0 = float(error.sum())
            dw = np.bincount(back, each * values, len(used)).astype(np.float32) + decay * w[used]
            xv = v[columns] * values[:, None]
            grad = (each * values)[:, None] * (sums[own] - xv)
            dv = np.stack([np.bincount(back, grad[:, f], len(used)) for f in range(FACTORS)], axis=1).astype(np.float32) + decay * v[used]
            g0 += d0 * d0
            w0 -= rate * d0 / math.sqrt(g0)
            gw[used] += dw * dw
            w[used] -= rate * dw / np.sqrt(gw[used])
            gv[used] += dv * dv
            v[used] -= rate * 0.5 * dv / np.sqrt(gv[used])
    return w0, w, v


def held_out(doc_id):
    """Rows that labels are never learnt from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> list:
    """(columns, values, label) of at most ``max_rows`` labelled documents that are not held out, by id."""
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
    few = stored(known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id").limit(max_rows), "labelled")

    def run(batches):
        for batch in sliced(batches, "text"):
            made = [inputs(t) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array([c for c, _ in made], pa.list_(pa.int32())), pa.array([x for _, x in made], pa.list_(pa.float32()))],
                ["doc_id", "y", "columns", "values"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(few), "doc_id")
    made = texts.mapInArrow(run, "doc_id long, y int, columns array<int>, values array<float>")
    # Repeats of an id leave one row each.
    one = made.groupBy("doc_id").agg(F.min(F.struct("y", "columns", "values")).alias("x")).select("doc_id", "x.*")
    return sorted((r[0], np.asarray(r[2], np.int32), np.asarray(r[3], np.float32), r[1]) for r in one.toLocalIterator()) if max_rows else []


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS):
    """Weights learnt from ``labels`` (doc_id, ``label`` 0 or 1) of rows that are not held out."""
    rows = sample(docs, labels, label, max_rows)
    return fit([(c, x) for _, c, x, _ in rows], np.array([y > 0 for *_, y in rows], np.float32))


def scored(docs: DataFrame, weights, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = [c for c in docs.columns if c != column]
    schema = StructType([docs.schema[c] for c in kept] + [StructField(column, DoubleType())])

    def run(batches):
        for batch in sliced(batches, "text"):
            made = [inputs(t) for t in utf8(batch, "text")]
            sizes = np.array([len(c) for c, _ in made])
            margin, _ = margins(shared.value, np.concatenate([c for c, _ in made]), np.concatenate([x for _, x in made]), np.cumsum(sizes) - sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(margin.astype(np.float64)))], names=schema.fieldNames())

    return docs.select(*kept).mapInArrow(run, schema)
