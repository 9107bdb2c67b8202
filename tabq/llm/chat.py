"""Chat formatting by columnar byte assembly, and reading the format back.

A turn becomes `### role: text</turn>` and a line end. A backslash precedes each backslash, `###` and
`</turn>` that a text holds itself (in roles also each colon), so the format can be read back. For a
batch of turns, numpy computes the lengths of all segments, their offsets and where each byte goes,
and all are copied into one buffer, of which the formatted chunks are slices.

Turns are range-partitioned by conversation and turn, so that a conversation of any length is
formatted by as many tasks as its size calls for, as consecutive chunks: no conversation is gathered.
A chunk carries the spans (bytes) of its assistant texts, the loss mask. Reading back passes a
conversation's chunks in order through running digests; only one batch is held.

Defined results: a NULL role or text is empty. Turns of one conversation are ordered by turn, NULL
first, then role and text; repeated rows are repeated turns. NULL is a conversation of its own. An
empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, COLON, CLOSE = b"### ", b": ", b"</turn>\n"
LOSS_ROLE = b"assistant"
CHUNKS = ("conv_id long, position long, n_turns int, text string, "
          "loss_starts array<int>, loss_lengths array<int>")
_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>\n))*+)</turn>\n", re.DOTALL)
_ESCAPE = re.compile(rb"\\(.)", re.DOTALL)


def _column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A column's bytes and the offsets of its rows, NULL as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _marks(data: np.ndarray, offsets: np.ndarray, colons: bool) -> np.ndarray:
    """Which bytes need a backslash."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    marks = data == ord("\\")
    if colons:
        marks |= data == ord(":")
    for control in (b"###", b"</turn>"):
        at = data == control[0]
        for i, c in enumerate(control[1:], 1):
            at[:-i or None] &= np.append(data[i:], np.zeros(0, np.uint8))[:len(data) - i] == c
            at[max(len(data) - i, 0):] = False
        marks |= at & (np.arange(len(data)) + len(control) <= ends)
    return marks


def _place(out: np.ndarray, starts: np.ndarray, data: np.ndarray, offsets: np.ndarray,
           marks: np.ndarray) -> None:
    """Scatter the rows' bytes, with their backslashes, to where the rows start in out."""
    shift = np.cumsum(marks)
    before = np.concatenate(([0], shift))[offsets[:-1]]
    lengths = np.diff(offsets)
    where = np.repeat(starts - offsets[:-1] - before, lengths) + np.arange(len(data)) + shift
    out[where] = data
    out[where[marks] - 1] = ord("\\")


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of formatted turns; where each starts, and the start and length of its text."""
    n = len(texts)
    (role, role_at), (text, text_at) = _column(roles), _column(texts)
    role_marks, text_marks = _marks(role, role_at, True), _marks(text, text_at, False)
    lengths = np.zeros((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(OPEN), len(COLON), len(CLOSE)
    for k, at, marks in ((1, role_at, role_marks), (3, text_at, text_marks)):
        extra = np.concatenate(([0], np.cumsum(marks)))
        lengths[:, k] = np.diff(at) + np.diff(extra[at])
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(n, 5)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    for k, fixed in ((0, OPEN), (2, COLON), (4, CLOSE)):
        out[starts[:, k, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    _place(out, starts[:, 1], role, role_at, role_marks)
    _place(out, starts[:, 3], text, text_at, text_marks)
    return out, starts[:, 0], starts[:, 3], lengths[:, 3]


def _format(batches):
    position = TaskContext.get().partitionId() << 40
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        out, starts, text_starts, text_lengths = assemble(batch.column("role"), batch.column("text"))
        conv = batch.column("conv_id").to_pylist()
        first = [i for i in range(n) if i == 0 or conv[i] != conv[i - 1]]
        edges = np.append(starts[first], len(out))
        chunks = pa.Array.from_buffers(
            pa.large_string(), len(first),
            [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())
        loss = np.array([r == LOSS_ROLE for r in batch.column("role").cast(pa.binary()).to_pylist()])
        spans = [[], []]
        for a, b, base in zip(first, first[1:] + [n], edges):
            own = np.flatnonzero(loss[a:b]) + a
            spans[0].append((text_starts[own] - base).astype(np.int32))
            spans[1].append(text_lengths[own].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv[i] for i in first], pa.int64()),
             pa.array([position + i for i in range(len(first))], pa.int64()),
             pa.array(np.diff(np.append(first, n)), pa.int32()), chunks,
             pa.array(spans[0], pa.list_(pa.int32())), pa.array(spans[1], pa.list_(pa.int32()))],
            names=["conv_id", "position", "n_turns", "text", "loss_starts", "loss_lengths"])
        position += len(first)


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted chunks (see CHUNKS) of rows conv_id, turn, role, text. Within a conversation, chunks
    go by position."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    parts = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionByRange(parts, "conv_id", "turn").sortWithinPartitions(
        "conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(
        _format, CHUNKS)


def unescaped(data: bytes) -> bytes:
    return _ESCAPE.sub(rb"\1", data)


def parse(chunk: bytes) -> list[tuple[bytes, bytes]]:
    """Role and text of the chunk's turns."""
    found, at = [], 0
    while at < len(chunk):
        turn = _TURN.match(chunk, at)
        if not turn:
            raise ValueError(f"not a turn at byte {at}")
        found.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return found


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.formatted, self.loss = conv, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, chunk: bytes, starts, lengths):
        self.formatted += len(chunk.decode())
        for role, text in parse(chunk):
            self.turns += 1
            self.turn_hash.update(role + b"\n" + text + b"\n")
        for s, n in zip(starts, lengths):
            text = unescaped(chunk[s:s + n])
            self.loss += len(text.decode())
            self.loss_hash.update(text)

    def row(self):
        return (self.conv, self.turns, self.turn_hash.hexdigest(), self.loss,
                self.loss_hash.hexdigest(), self.formatted)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def _digest(batches):
    now = None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist()
                   for c in ("conv_id", "loss_starts", "loss_lengths")]
        texts = batch.column("text").cast(pa.binary())
        for i, (conv, starts, lengths) in enumerate(zip(*columns)):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            now.add(texts[i].as_py(), starts, lengths)
        yield _rows(done)
    if now is not None:
        yield _rows([now.row()])


def _rows(rows):
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def read_back(chunks: DataFrame) -> DataFrame:
    """DIGESTS of each conversation, from its chunks alone."""
    return chunks.repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(
        _digest, DIGESTS)
