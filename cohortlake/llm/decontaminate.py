"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised to words and cut into windows of ``window``
words (an item of fewer words is one window).  The automaton reads word
numbers, so it has one state per window word and a match ends at a word; each
document is normalised and read once.  Offsets of hit words in the original
text are looked up only for documents with a hit.

The benchmark is read by the driver in blocks of at most ``block_words``
words (about 10 MB of automaton for the default), whatever its size; each
block is one pass over the documents, the hits of earlier blocks travelling
along with the rows through the shared scratch folder.

Defined cases: null, empty or wordless text has no words and no hits; null or
wordless items have no windows; a null item_id marks hits but is not listed;
equal item_ids count once; repeated rows each get their result; all columns of
the input are kept, and result columns replace columns of the same names.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cohortlake.llm.common import sliced, stored, utf8

#: A-Z to a-z, other ASCII but digits and a-z to a space; bytes of other characters stay.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_WORDS = 100_000
SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
RESULT = {"n_words": LongType(), "n_hit": LongType(), "items": ArrayType(StringType()), "hit_words": ArrayType(LongType()), "hit_spans": ArrayType(SPAN)}


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def build(items: list[tuple[str | None, bytes]], window: int):
    """(word numbers, automaton) of a block of items; the automaton's values are (length, item_ids)."""
    numbers: dict[bytes, int] = {}
    owners: dict[tuple, set] = {}
    for item_id, text in items:
        seq = tuple(numbers.setdefault(w, len(numbers) + 1) for w in normal_words(text))
        for i in range(max(1, len(seq) - window + 1) if seq else 0):
            owners.setdefault(seq[i : i + window], set()).add(item_id)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for seq, ids in owners.items():
        automaton.add_word(seq, (len(seq), ids))
    automaton.make_automaton()
    return numbers, automaton


def scan(words: list[bytes], numbers: dict, automaton) -> tuple[set[int], set]:
    """Numbers of the hit words, and the items, of one document."""
    hit: set[int] = set()
    found: set = set()
    if numbers:
        for end, (length, ids) in automaton.iter(tuple(numbers.get(w, 0) for w in words)):
            hit.update(range(end - length + 1, end + 1))
            found |= ids
    return hit, found


def word_spans(text: str, hit: list[int]) -> list[dict]:
    """Code point spans, in the original, of runs of hit words."""
    places = [m.span() for m in ORIGINAL_WORD.finditer(text)]
    spans: list[dict] = []
    last = -2
    for w in hit:
        if w == last + 1:
            spans[-1]["end"] = places[w][1]
        else:
            spans.append({"start": places[w][0], "end": places[w][1]})
        last = w
    return spans


def blocks(benchmark: DataFrame, block_words: int):
    """The items (item_id as text, UTF-8 text) in blocks of bounded size."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("text is not null").toLocalIterator():
        text = row[1].encode()
        n = len(normal_words(text))
        if held and size + n > block_words:
            yield held
            held, size = [], 0
        held.append((row[0], text))
        size += n
    yield held


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted item_ids), hit_words (numbers) and hit_spans (code points)."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in RESULT]
    schema = StructType([docs.schema[c] for c in kept] + [StructField(k, v) for k, v in RESULT.items()])
    out = docs.select(*kept, *[F.lit(None).cast(v).alias(k) for k, v in RESULT.items()])
    for k, block in enumerate(blocks(benchmark, block_words)):
        if k:
            out = stored(out, "scanned")
        out = out.mapInArrow(scanner(spark.sparkContext.broadcast(block), window, len(kept), schema), schema)
    return out


def scanner(block, window: int, n_kept: int, schema: StructType):
    def run(batches):
        numbers, automaton = build(block.value, window)
        for batch in sliced(batches, "text"):
            columns = {k: [] for k in RESULT}
            earlier = zip(batch.column("items").to_pylist(), batch.column("hit_words").to_pylist())
            for text, (items, hits) in zip(utf8(batch, "text"), earlier):
                words = normal_words(text)
                hit, found = scan(words, numbers, automaton)
                hit = sorted(hit.union(hits or ()))
                columns["n_words"].append(len(words))
                columns["n_hit"].append(len(hit))
                columns["items"].append(sorted(found.union(items or ()) - {None}))
                columns["hit_words"].append(hit)
                columns["hit_spans"].append(word_spans(text.decode(), hit) if hit else [])
            types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            made = [pa.array(v, t) for v, t in zip(columns.values(), types)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n_kept)] + made, names=schema.fieldNames())

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, share: float = 0.0) -> DataFrame:
    """The rows of ``docs`` of whose words at most ``share`` lie in benchmark windows; columns unchanged."""
    names = docs.columns
    numbered = docs.toDF(*[c if c == "text" else f"__{i}" for i, c in enumerate(names)])
    found = find_contamination(numbered, benchmark, window)
    return found.where(F.col("n_hit") <= share * F.col("n_words")).select(*numbered.columns).toDF(*names)
