"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A tokenizer's merges cover the strings that people write.  Runs of
``[A-Za-z0-9+/_=-]`` are cut at the pieces (between separators ``+/_=-``) that
a fixed pattern, a UUID or a digest of a known length covers whole.  A part of
at least ``min_chars`` characters with a letter whose characters per token
(tiktoken ranks file ``vocabulary``) fall below ``max_ratio`` is a random
string.  Of other parts, the stretches of whole pieces are random strings that
have that length and that ratio without counting separators: each time the one
that is furthest below, so plain words beside a secret do not dilute it.  A
piece that a fixed pattern covers in part is tested whole, and its span may
overlap the pattern's.  Words and identifiers stay by their high ratio.  Only
such parts are tokenised; the whole text is searched.

Defined cases: null text is empty and has no spans; repeated rows each get
their result; all columns of the input are kept, and ``spans`` (or ``text``
and ``n_chars`` when redacting) replace columns of those names.  Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cohortlake.llm.common import sliced, utf8

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The patterns.  Runs of one class are maximal, so a least length in the pattern equals a later check.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
UUID = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}-?(?:[0-9a-fA-F]{4}-?){3}[0-9a-fA-F]{12}(?![A-Za-z0-9])")
DIGEST = re.compile("[0-9a-f]+|[0-9A-F]+")
DIGEST_CHARS = (32, 40, 48, 56, 64, 96, 128)
PIECE = re.compile("[A-Za-z0-9]+")
LETTER = re.compile("[A-Za-z]")
SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())]))
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoding(ranks_file: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
    return tiktoken.Encoding("secrets", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, start: int, end: int, base: list[tuple[int, int, int]]):
    """(start, end, pieces) of the parts of a run between the pieces that are a base span's, a UUID's or a digest."""
    covers = [(s, e) for s, _, e in base if s < end and start < e] + [m.span() for m in UUID.finditer(text, start, end)]
    at, pieces = start, []
    for m in PIECE.finditer(text, start, end):
        s, e = m.span()
        if any(a <= s and e <= b for a, b in covers) or e - s in DIGEST_CHARS and DIGEST.fullmatch(text, s, e):
            if pieces:
                yield at, s, pieces
            at, pieces = e, []
        else:
            pieces.append((s, e))
    if pieces:
        yield at, end, pieces


def stretches(pieces: list[tuple[int, int]], weights: list[float], min_chars: int) -> list[tuple[int, int]]:
    """Spans of disjoint stretches of pieces with a positive sum of weights, the largest first, of ``min_chars`` at least."""
    sums = [0.0]
    for w in weights:
        sums.append(sums[-1] + w)
    found, todo = [], [(0, len(pieces))]
    while todo:
        lo, hi = todo.pop()
        best, least, i = (0.0, 0, 0), lo, lo
        for j in range(lo, hi):
            while i <= j and pieces[j][1] - pieces[i][0] >= min_chars:
                if sums[i] <= sums[least]:
                    least = i
                i += 1
            if i > lo and sums[j + 1] - sums[least] > best[0]:
                best = (sums[j + 1] - sums[least], least, j + 1)
        if best[0] > 0:
            found.append((pieces[best[1]][0], pieces[best[2] - 1][1]))
            todo += [(lo, best[1]), (best[2], hi)]
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping for each kind."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def scanner(ranks_file, min_chars: int, max_ratio: float):
    """A function from a text to its sorted spans (start, kind, end)."""
    runs = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % min_chars)
    made = []

    def tokens(part: str) -> int:
        if not made:
            made.append(encoding(ranks_file.value))
        return len(made[0].encode_ordinary(part))

    def spans(text: str) -> list[tuple[int, int, int]]:
        base = base_spans(text)
        added, near, seen = [], [], 0
        for m in runs.finditer(text):
            # Base spans and runs both go forward: those that end before this run are done with.
            while seen < len(base) and base[seen][0] < m.end():
                near.append(base[seen])
                seen += 1
            near = [x for x in near if m.start() < x[2]]
            for s, e, pieces in parts(text, m.start(), m.end(), near):
                if e - s < min_chars or not LETTER.search(text, s, e):
                    continue
                if (e - s) / tokens(text[s:e]) < max_ratio:
                    added.append((s, 3, e))
                    continue
                weights = [max_ratio * tokens(text[a:b]) - (b - a) for a, b in pieces]
                added += [(a, 3, b) for a, b in stretches(pieces, weights, min_chars) if LETTER.search(text, a, b)]
        return sorted(base + added)

    return spans


def _ranks(docs: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as f:  # a vocabulary file of fixed size beside the driver program
        return docs.sparkSession.sparkContext.broadcast(f.read())


def find_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, min_chars: int = 20, max_ratio: float = 2.0) -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end) by start, then kind in the order of KINDS."""
    ranks = _ranks(docs, vocabulary)
    kept = [c for c in docs.columns if c != "spans"]
    schema = StructType([docs.schema[c] for c in kept] + [StructField("spans", SPANS)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        spans = scanner(ranks, min_chars, max_ratio)
        for batch in sliced(batches, "text"):
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(t.decode())] for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, arrow)], names=schema.fieldNames())

    return docs.select(*kept).mapInArrow(run, schema)


def redact_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, min_chars: int = 20, max_ratio: float = 2.0, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``; overlapping spans are one.

    Columns and rows stay; ``n_chars``, where there is one, follows the change
    of length of the texts that change.
    """
    ranks = _ranks(docs, vocabulary)
    schema = docs.schema

    def run(batches):
        spans = scanner(ranks, min_chars, max_ratio)
        for batch in sliced(batches, "text"):
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else None
            for i, text in enumerate(texts):
                out, at = [], 0
                for s, _, e in spans(text) if text else ():
                    if s >= at:
                        out += [text[at:s], mark]
                    at = max(at, e)
                if out:
                    texts[i] = "".join(out) + text[at:]
                    if sizes and sizes[i] is not None:
                        sizes[i] += len(texts[i]) - len(text)
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array(texts, batch.column("text").type)
            if sizes is not None:
                columns["n_chars"] = pa.array(sizes, batch.column("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, schema)


def span_list(spans):
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
