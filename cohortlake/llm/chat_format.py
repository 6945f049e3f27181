"""Chat formatting by columnar byte assembly.

A conversation becomes ``<|turn|>role<|text|>text<|end|>\\n`` for each turn.
Control strings inside roles and texts get a backslash after their first
character (and one more if they have some already), which ``unescape`` takes
away again.

Rows are dealt by conversation and sorted by turn.  A task assembles one batch
of turns at a time: numpy computes the lengths of the five segments of each
turn, their cumulative offsets and scatter indices, and copies headers and
contents into one preallocated buffer, which becomes the data of an Arrow
column.  The texts under the loss mask (those of assistants) come as spans of
bytes of the formatted text, without headers.

Output rows are parts: a conversation is one part unless it grows beyond
``part_bytes``; then further parts follow, in order, so a conversation of any
length passes through a task of bounded memory.

Defined cases: null role or text is empty; a null conv_id is one conversation;
null turns come first; rows of equal conv_id and turn are ordered by role, then
text; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cohortlake.llm.common import sliced

TURN, TEXT, END = b"<|turn|>", b"<|text|>", b"<|end|>\n"
# Strings that mark turns here or in common templates, split after the first character.
CONTROLS = (r"(<)(\\*)(\|turn\|>|\|text\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>)", r"(\[)(\\*)(/?INST\])")
ROLES = ("assistant",)
PART_BYTES = 16 << 20
SCHEMA = "conv_id long, part int, n_turns int, formatted string, loss_spans array<struct<start:int,end:int>>"


def escape(column: pa.Array) -> pa.Array:
    """A text column with its control strings escaped."""
    for pattern in CONTROLS:
        column = pc.replace_substring_regex(column, pattern, r"\1\2\\\3")
    return column


def unescape(text: str) -> str:
    for pattern in CONTROLS:
        text = re.sub(pattern, lambda m: m[1] + m[2][1:] + m[3] if m[2] else m[0], text)
    return text


def assemble(segments: list[bytes | pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each segment of each row) of ``n`` rows made of constants and text columns."""
    lengths = np.empty((n, len(segments)), np.int64)
    views = []
    for k, segment in enumerate(segments):
        if isinstance(segment, bytes):
            lengths[:, k] = len(segment)
            views.append(np.frombuffer(segment, np.uint8))
        else:
            _, offsets, data = segment.cast(pa.large_binary()).buffers()
            ends = np.frombuffer(offsets, np.int64)[segment.offset : segment.offset + n + 1]
            lengths[:, k] = np.diff(ends)
            views.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8))
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, (segment, view) in enumerate(zip(segments, views)):
        if isinstance(segment, bytes):
            out[starts[:, k, None] + np.arange(len(segment))] = view
        else:
            taken = np.cumsum(lengths[:, k]) - lengths[:, k]
            out[np.repeat(starts[:, k] - taken, lengths[:, k]) + np.arange(len(view))] = view
    return out, starts


def format_turns(batch: pa.RecordBatch):
    """(conv_ids, bytes, end of each turn, loss spans (n, 2), is loss) of a batch of sorted turns."""
    role, text = (escape(pc.fill_null(batch.column(c), "")) for c in ("role", "text"))
    data, starts = assemble([TURN, role, TEXT, text, END], batch.num_rows)
    loss = pc.is_in(batch.column("role"), pa.array(ROLES)).to_numpy(zero_copy_only=False)
    return batch.column("conv_id").to_pylist(), data, starts[:, 4] + len(END), starts[:, 3:5], loss


def format_conversations(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(conv_id, part, n_turns, formatted, loss_spans) from (conv_id, turn, role, text); parts of a conversation stand in order."""

    def run(batches):
        number, at = 0, object()
        held: list[tuple[bytes, int, list]] = []

        def emit():
            nonlocal held, number
            spans, data, base = [], b"".join(d for d, _, _ in held), 0
            for d, _, own in held:
                spans += [{"start": int(s) + base, "end": int(e) + base} for s, e in own]
                base += len(d)
            made = [pa.array([at], pa.int64()), pa.array([number], pa.int32()), pa.array([sum(n for _, n, _ in held)], pa.int32()),
                    pa.array([data], pa.binary()).cast(pa.string()), pa.array([spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            held, number = [], number + 1
            return pa.RecordBatch.from_arrays(made, names=["conv_id", "part", "n_turns", "formatted", "loss_spans"])

        for batch in sliced(batches, "text"):
            ids, data, ends, spans, loss = format_turns(batch)
            first = 0
            while first < len(ids):
                stop = first + 1
                while stop < len(ids) and ids[stop] == ids[first]:
                    stop += 1
                if held and ids[first] != at:
                    yield emit()
                if ids[first] != at:
                    at, number = ids[first], 0
                start = int(ends[first - 1]) if first else 0
                own = [spans[i] - start for i in range(first, stop) if loss[i]]
                held.append((data[start : int(ends[stop - 1])].tobytes(), stop - first, own))
                if sum(len(d) for d, _, _ in held) > part_bytes:
                    yield emit()
                first = stop
        if held:
            yield emit()

    dealt = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return dealt.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted part."""
    out = []
    for turn in formatted.split(TURN.decode())[1:]:
        role, text = turn.split(TEXT.decode(), 1)
        out.append((unescape(role), unescape(text[: -len(END)])))
    return out


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation, from the formatted parts alone: numbers and digests of turns and of the text under the loss mask.

    Parts must stand as ``format_conversations`` leaves them; they are digested
    one after the other.
    """

    def run(batches):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        at, state = None, None

        def row():
            n, turns, chars, loss, size = state
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((at, n, turns.hexdigest(), chars, loss.hexdigest(), size), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=names)

        for batch in batches:
            for part in batch.to_pylist():
                if part["part"] == 0:
                    if state:
                        yield row()
                    at, state = part["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(part["formatted"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                raw = part["formatted"].encode()
                for span in part["loss_spans"]:
                    text = unescape(raw[span["start"] : span["end"]].decode())
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(part["formatted"])
        if state:
            yield row()

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
