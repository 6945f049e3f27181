"""LM scoring by masked pseudo-likelihood with a bidirectional window network.

Every token is predicted from the two tokens before and the two after it.
Words are counted over the whole corpus; the most frequent get a class of
their own, all others one of ``SHARED`` hashed classes.  A numpy network
(class embeddings of the four neighbours, one tanh layer, softmax over
classes) gives the class, and the corpus counts give the word within its
class.  A document's score is the sum of its tokens' conditional
log-probabilities.

Texts are split into words twice: for the counts, and once more when every
token's class number is written, a byte each, beside the row.  Training and
scoring read these bytes.

Training covers every document once: it runs in ``ROUNDS`` rounds over
disjoint parts of the corpus.  In a round each part trains a copy of the network
and hands in the weights times its tokens; Spark sums them, and the mean starts
the next round.  Rounds and parts are dealt by a hash of doc_id and text, in the
order of the hash, and the number of parts follows from that of the tokens (its
square root, so that parts and their size both grow), so scores do not depend on
files or executors but for the rounding of sums.  Rows equal in doc_id and text
train in one part.  The driver only ever holds one set of weights (fixed size)
and the frequent words (``TOP``, fixed size).

Within a class every word is as likely as its own count of the corpus says.
The counts are a table.  The frequent words' are also broadcast, which only
saves shuffling them; a document's other words are joined to the table as
(row, word, occurrences), and the logarithms of their counts are added to its
sum.  A word that is not broadcast makes up at most about 1 / ``TOP`` of the
tokens, so no key of that join is hot.

A word that the model's corpus does not hold (for a model of another corpus)
is as likely as one that it holds once.

Defined cases: null, empty and blank texts have no tokens, a sum of 0 and no
mean (null); an empty corpus scores by the untrained network; null doc_ids are
scored; repeated rows get equal scores; further columns are kept (or those that
the caller names), and result columns replace columns of the same names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, MapType, StructType

from cohortlake.llm.common import free_name, sliced, stored, utf8

OWN, SHARED = 95, 32
CLASSES = OWN + SHARED + 1  # and one for places beyond the ends of a text
EDGE = CLASSES - 1
TOP = 20_000
SIZE, HIDDEN, SIDE = 8, 24, 2
BATCH = 1024
ROUNDS = 2
#: Tokens of a round are dealt into as many parts as their square root over this.
PARTS = 256
#: Tokens that a task holds at once, but for a longer text.
TOKENS = 1 << 18
RESULT = ("n_tokens", "sum_logprob", "mean_logprob")


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents."""

    def run(batches):
        def emit(counts):
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        counts: Counter[bytes] = Counter()
        for batch in sliced(batches, "text"):
            for text in utf8(batch, "text"):
                counts.update(tokens(text))
            if len(counts) > 200_000:
                yield emit(counts)
                counts = Counter()
        if counts:
            yield emit(counts)

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon(dict):
    """Numbers of words; ``classes`` and ``within`` give a number's class and log-probability within it.

    The numbers of words that are not frequent are those of their hashed class,
    below ``SHARED``, whose ``within`` lacks the logarithm of the word's count;
    they are held for a bounded number of words.
    """

    def __init__(self, top: list[tuple[bytes, int]], rest: dict[int, int]):
        """``top``: the frequent words; ``rest``: by shared class, occurrences of all other words."""
        super().__init__((w, SHARED + k) for k, (w, _) in enumerate(top))
        self.frequent = dict(self)
        counts = np.array([n for _, n in top], float)
        other = np.array([rest.get(c, 0) for c in range(SHARED)], float) + 1
        shared = [OWN + zlib.crc32(w) % SHARED for w, _ in top[OWN:]]
        self.classes = np.array([*range(OWN, OWN + SHARED), *range(min(OWN, len(top))), *shared], np.int64)
        mass = np.bincount(self.classes, np.concatenate([other, counts]), CLASSES)
        self.within = np.log(np.concatenate([np.ones(SHARED), counts]) / mass[self.classes])

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
            self.update(self.frequent)
        number = self[word] = zlib.crc32(word) % SHARED
        return number


def lexicon(counts: DataFrame) -> tuple[list[tuple[bytes, int]], dict[int, int]]:
    """The arguments of a Lexicon: frequent words, and the occurrences of the others by shared class."""
    # Frequent are the words above the least step of frequency that leaves TOP of them at most, and those with a class of their own.
    step = F.floor(F.log("n") * 16)
    total, least = 0, 1 << 30
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row[1]
        if total > TOP:
            break
        least = row[0]
    own = counts.orderBy(F.desc("n"), "word").limit(OWN).collect()
    frequent = {bytes(w): n for w, n in own + counts.where(step >= least).collect()}
    sums = counts.groupBy((F.crc32("word") % SHARED).alias("c")).agg(F.sum("n").alias("n")).collect()
    rest = {int(r.c): r.n for r in sums}
    for w, n in frequent.items():
        rest[zlib.crc32(w) % SHARED] -= n
    return sorted(frequent.items(), key=lambda x: (-x[1], x[0])), rest


def initial(seed: int = 7) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = ((CLASSES, SIZE), (2 * SIDE * SIZE, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))
    return [rng.normal(0, 0.3 if k in (0, 1, 3) else 0, s).astype(np.float32) / (1 if k == 0 else 2) for k, s in enumerate(shapes)]


def windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(targets, neighbours (n, 2 * SIDE)) of several texts' class numbers."""
    edge = np.full(SIDE, EDGE, np.int64)
    flat = np.concatenate([part for x in ids for part in (edge, x)] + [edge])
    places = np.flatnonzero(flat != EDGE)
    around = np.stack([flat[places + d] for d in (*range(-SIDE, 0), *range(1, SIDE + 1))], axis=1)
    return flat[places], around


def forward(net, around: np.ndarray):
    """(inputs, hidden values, outputs up to a constant of their row)."""
    embed, w1, b1, w2, b2 = net
    x = embed.take(around.ravel(), axis=0).reshape(len(around), -1)
    h = x @ w1
    h += b1
    np.tanh(h, out=h)
    z = h @ w2
    z += b2
    if (np.abs(w2).sum(axis=0) + np.abs(b2)).max() > 60:  # else no exponential overflows, as |h| <= 1
        z -= z.max(axis=1, keepdims=True)
    return x, h, z


def log_probabilities(net, targets: np.ndarray, around: np.ndarray) -> np.ndarray:
    out = np.empty(len(targets))
    for at in range(0, len(targets), BATCH):
        z = forward(net, around[at : at + BATCH])[2]
        t = targets[at : at + BATCH]
        own = z[np.arange(len(t)), t]
        out[at : at + BATCH] = own - np.log(np.exp(z, out=z).sum(axis=1))
    return out


def gradients(net, targets: np.ndarray, around: np.ndarray) -> tuple:
    """Of the mean negative log-probability of the targets, by each array of the network."""
    embed, w1, _, w2, _ = net
    x, h, p = forward(net, around)
    np.exp(p, out=p)
    p *= (1 / (p.sum(axis=1, keepdims=True) * len(p))).astype(p.dtype)
    p[np.arange(len(p)), targets] -= 1 / len(p)
    dh = p @ w2.T
    dh *= 1 - h * h
    dx = dh @ w1.T
    to = (around.reshape(-1, 1) * SIZE + np.arange(SIZE)).ravel()
    de = np.bincount(to, dx.ravel(), embed.size).reshape(embed.shape).astype(embed.dtype)
    return de, x.T @ dh, dh.sum(axis=0), h.T @ p, p.sum(axis=0)


def learn(net, squares, targets: np.ndarray, around: np.ndarray, rate: float = 0.05) -> None:
    """One pass of Adagrad over the tokens, in place."""
    for at in range(0, len(targets), BATCH):
        for v, s, g in zip(net, squares, gradients(net, targets[at : at + BATCH], around[at : at + BATCH])):
            s += g * g
            v -= rate * g / np.sqrt(s)


def classified(texts: list[bytes], lex: Lexicon) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Tokens of each text and their numbers."""
    split = [tokens(t) for t in texts]
    return split, [np.fromiter(map(lex.__getitem__, s), np.int64, len(s)) for s in split]


def others(words: list[bytes], numbers: np.ndarray) -> dict[bytes, int]:
    """Occurrences of the words of a text that are not frequent."""
    return Counter(words[k] for k in np.flatnonzero(numbers < SHARED).tolist())


class Coded:
    """A written table of documents: the columns kept, a row number, a hash of doc_id and text, and of the
    tokens their number, class numbers, log-probability within the classes, and the words that are not frequent."""

    PARTS = {"row": LongType(), "hash": LongType(), "tokens": LongType(), "codes": BinaryType(), "within": DoubleType(), "others": MapType(BinaryType(), LongType())}

    def __init__(self, docs: DataFrame, lex, kept: list[str]):
        self.names = names = {n: free_name(docs.select(*kept), f"__{n}") for n in self.PARTS}
        schema = StructType([docs.schema[c] for c in kept])
        for n in ("hash", "tokens", "codes", "within", "others"):
            schema = schema.add(names[n], self.PARTS[n])
        text, kinds = free_name(docs.select(*kept), "__text"), [docs.schema[c].name for c in kept]

        def run(batches):
            known = Lexicon(*lex.value)
            for batch in sliced(batches, text, 1 << 20):
                split, numbers = classified(utf8(batch, text), known)
                sizes = [len(x) for x in numbers]
                codes = [known.classes[x].astype(np.uint8).tobytes() for x in numbers]
                within = [float(known.within[x].sum()) for x in numbers]
                found = [others(w, x) for w, x in zip(split, numbers)]
                at = pa.array(np.cumsum([0] + [len(x) for x in found]), pa.int32())
                words, times = [w for x in found for w in x], [n for x in found for n in x.values()]
                rest = pa.MapArray.from_arrays(at, pa.array(words, pa.binary()), pa.array(times, pa.int64()))
                own = [batch.column(c) for c in [*kinds, names["hash"]]]
                made = [pa.array(sizes, pa.int64()), pa.array(codes, pa.binary()), pa.array(within, pa.float64()), rest]
                yield pa.RecordBatch.from_arrays([*own, *made], names=schema.fieldNames())

        key = F.xxhash64(*[c for c in ("doc_id", "text") if c in docs.columns])
        made = docs.select(*kept, key.alias(names["hash"]), F.col("text").cast("string").alias(text)).mapInArrow(run, schema)
        # Stored, so that a row keeps its number.
        self.rows = stored(made.withColumn(names["row"], F.monotonically_increasing_id()), "lm-rows")

    def col(self, name: str):
        return F.col(self.names[name])


def trained(coded: Coded, net: list[np.ndarray], part: int) -> list[np.ndarray]:
    """The mean of the networks that the parts of a round train, weighed by tokens."""
    some = coded.rows.select(coded.col("hash").alias("hash"), coded.col("tokens").alias("tokens"), coded.col("codes").alias("codes")).where(F.pmod("hash", F.lit(ROUNDS)) == part)
    tokens_of = some.agg(F.sum("tokens")).first()[0]
    if not tokens_of:
        return net
    start = coded.rows.sparkSession.sparkContext.broadcast(net)
    total = sum(v.size for v in net)

    def run(batches):
        own = [v.copy() for v in start.value]
        squares, n = [np.full_like(v, 1e-6) for v in own], 0
        for batch in sliced(batches, "codes", TOKENS):
            targets, around = windows(class_numbers(batch, "codes"))
            learn(own, squares, targets, around)
            n += len(targets)
        if n:
            values = np.concatenate([v.ravel() for v in own]).astype(np.float64) * n
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total + 1)), pa.array(np.append(values, n))], names=["at", "value"])

    dealt = some.repartition(math.ceil(math.sqrt(tokens_of) / PARTS), "hash").sortWithinPartitions("hash", "codes").select("codes")
    sums = dealt.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    start.destroy()
    flat = np.zeros(total + 1)
    for at, value in sums:
        flat[at] = value
    ends = np.cumsum([v.size for v in net])
    return [(flat[e - v.size : e].reshape(v.shape) / flat[-1]).astype(np.float32) for v, e in zip(net, ends)]


def class_numbers(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    return [np.frombuffer(c, np.uint8) for c in batch.column(column).to_pylist()]


def vocabulary(docs: DataFrame):
    """(broadcast arguments of a Lexicon, (word, n) of all words) of a corpus."""
    counts = stored(word_counts(docs), "word-counts")
    return docs.sparkSession.sparkContext.broadcast(lexicon(counts)), counts


def network(coded: Coded) -> list[np.ndarray]:
    net = initial()
    for part in range(ROUNDS):
        net = trained(coded, net, part)
    return net


def fit(docs: DataFrame):
    """(broadcast arguments of a Lexicon, network, (word, n) of all words) of a corpus (doc_id, text)."""
    lex, counts = vocabulary(docs)
    return lex, network(Coded(docs, lex, [])), counts


def lm_scores(docs: DataFrame, model=None, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (its ``columns``, by default all) with n_tokens, sum_logprob and mean_logprob under a model (by default one fitted to them)."""
    kept = [c for c in (docs.columns if columns is None else columns) if c not in RESULT]
    if model is None:
        lex, counts = vocabulary(docs)
        coded = Coded(docs, lex, kept)
        net = network(coded)
    else:
        lex, net, counts = model
        coded = Coded(docs, lex, kept)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    names = coded.names
    plain = [*kept, names["row"], names["tokens"]]
    schema = StructType([coded.rows.schema[c] for c in plain]).add(names["within"], DoubleType())

    def run(batches):
        for batch in sliced(batches, names["codes"], TOKENS):
            ids = class_numbers(batch, names["codes"])
            logs = log_probabilities(shared.value, *windows(ids))
            ends = np.concatenate([[0.0], np.cumsum(logs)])[np.cumsum([0] + [len(x) for x in ids])]
            sums = np.diff(ends) + np.asarray(batch.column(names["within"]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in schema.names[:-1]], pa.array(sums, pa.float64())], names=schema.names)

    scored = coded.rows.select(*plain, names["codes"], names["within"]).mapInArrow(run, schema)
    words = coded.rows.select(coded.col("row").alias("row"), F.explode(coded.col("others")).alias("word", "times"))
    # The logarithm of a count of one adds nothing.
    terms = words.join(counts.where("n > 1"), "word").groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("more"))
    terms = terms.select(F.col("row").alias(names["row"]), F.col("more").alias(names["others"]))
    total = coded.col("within") + F.coalesce(coded.col("others"), F.lit(0.0))
    mean = F.when(coded.col("tokens") > 0, total / coded.col("tokens"))
    return scored.join(terms, names["row"], "left").select(*kept, coded.col("tokens").alias("n_tokens"), total.alias("sum_logprob"), mean.alias("mean_logprob"))
