"""Chat formatting by columnar byte assembly.

A turn is written as ``### role: text</turn>`` and a line break. Inside roles and texts a backslash goes before each
backslash, before ``###`` and before ``</turn>``, in roles also before a colon, so that none of the template's own
marks can be forged and dropping the backslashes gives back what was there.

A batch is assembled as a whole: numpy finds the places that need a backslash, sums up the lengths of all segments to
offsets, and copies headers, texts and marks by scatter indices into one preallocated buffer, which becomes the
Arrow column as it is.

Each row yields its own piece of the conversation and the place of that; a conversation is the concatenation of its pieces by
place, so one of any length is never held in memory. Reading back sorts pieces by conversation and place, however they
were stored, and streams over them in the same way.

Null role or text: empty. Null conv_id: one conversation. Null turns come first; rows with equal turns are ordered by
role, then text, and repeated rows are each a turn. Extra columns are ignored; no rows, no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import byte_arrays, bytes_of, slices

# The template.
HEADER, MIDDLE, FOOTER = b"### ", b": ", b"</turn>\n"
LEARNED = b"assistant"

ESCAPED = re.compile(rb"\\(.)", re.DOTALL)
PIECE = re.compile(rb"### ((?:[^\\:]|\\.)*): (.*)</turn>\n", re.DOTALL)


def _starts_of(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where the mark begins, overlapping occurrences included."""
    n = max(len(data) - len(mark) + 1, 0)
    found = np.ones(n, bool)
    for i, byte in enumerate(mark):
        found &= data[i : i + n] == byte
    return np.flatnonzero(found)


def _marked(data: np.ndarray, starts: np.ndarray, marks: tuple[bytes, ...]) -> np.ndarray:
    """Sorted places that need a backslash. A mark may not reach from one row into the next."""
    places = []
    for mark in marks:
        at = _starts_of(data, mark)
        row_end = starts[np.searchsorted(starts, at, side="right")]
        places.append(at[at + len(mark) <= row_end])
    return np.unique(np.concatenate(places))


TEXT_MARKS = (b"\\", b"###", b"</turn>")
ROLE_MARKS = (*TEXT_MARKS, b":")


def _copied(out: np.ndarray, data: np.ndarray, starts: np.ndarray, places: np.ndarray, to: np.ndarray) -> None:
    """Copy rows of ``data`` to the offsets ``to``, a backslash before each of the places."""
    shift = np.repeat(to - starts[:-1] - np.searchsorted(places, starts[:-1]), np.diff(starts))
    index = np.arange(len(data)) + shift
    if len(places):
        index += np.searchsorted(places, np.arange(len(data)), side="right")
        out[index[places] - 1] = ord("\\")
    out[index] = data


def _constant(out: np.ndarray, value: bytes, to: np.ndarray) -> None:
    out[to[:, None] + np.arange(len(value))] = np.frombuffer(value, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces, and where the escaped text begins and ends in each (bytes)."""
    (role, role_at), (text, text_at) = byte_arrays(roles), byte_arrays(texts)
    role_marks, text_marks = _marked(role, role_at, ROLE_MARKS), _marked(text, text_at, TEXT_MARKS)
    n_role = np.diff(role_at) + np.diff(np.searchsorted(role_marks, role_at))
    n_text = np.diff(text_at) + np.diff(np.searchsorted(text_marks, text_at))
    segments = np.stack([np.full(len(roles), len(HEADER)), n_role, np.full(len(roles), len(MIDDLE)), n_text, np.full(len(roles), len(FOOTER))], 1)
    offsets = np.concatenate([[0], np.cumsum(segments)])
    at = offsets[:-1].reshape(-1, 5)
    out = np.empty(offsets[-1], np.uint8)
    _constant(out, HEADER, at[:, 0])
    _copied(out, role, role_at, role_marks, at[:, 1])
    _constant(out, MIDDLE, at[:, 2])
    _copied(out, text, text_at, text_marks, at[:, 3])
    _constant(out, FOOTER, at[:, 4])
    whole = np.concatenate([at[:, 0], offsets[-1:]])
    pieces = pa.Array.from_buffers(pa.large_binary(), len(roles), [None, pa.py_buffer(whole), pa.py_buffer(out)])
    return pieces, at[:, 3] - at[:, 0], at[:, 4] - at[:, 0]


PIECES = "place long, piece binary, text_from long, text_to long, learned boolean"


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, the ``place`` of each turn in its conversation (from 0), its ``piece``, the byte range of its text in it,
    and whether that range is under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = None, -1
        for whole in batches:
            for batch in slices(whole, "text"):
                pieces, begin, end = assemble(batch.column("role"), batch.column("text"))
                learned = [r == LEARNED for r in batch.column("role").to_pylist()]
                places = []
                for conv in batch.column("conv_id").to_pylist():
                    last, place = (conv,), place + 1 if last == (conv,) else 0
                    places.append(place)
                columns = [pa.array(places, pa.int64()), pieces.cast(pa.binary()), pa.array(begin), pa.array(end), pa.array(learned, pa.bool_())]
                names = ["conv_id", *[c.split()[0] for c in PIECES.split(", ")]]
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names)

    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "turn", bytes_of("role").alias("role"), bytes_of("text").alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, {PIECES}")


def parse_piece(piece: bytes) -> tuple[bytes, bytes]:
    """Role and text."""
    found = PIECE.fullmatch(piece)
    if not found:
        raise ValueError("not a formatted turn")
    return ESCAPED.sub(rb"\1", found[1]), ESCAPED.sub(rb"\1", found[2])


def characters(data: bytes) -> int:
    """Code points: bytes that begin a character."""
    return len(data.translate(None, bytes(range(0x80, 0xC0))))


READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from the output of ``format_turns`` alone, in whatever order it was stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state: list | None = None  # conv_id, turns, hash of turns, characters learned, hash of those, characters

        def close() -> None:
            if state:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def flushed() -> pa.RecordBatch:
            columns = zip(*done) if done else [()] * 6
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            done.clear()
            return out

        for batch in batches:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            schema = pa.schema([("conv_id", batch.schema.field(0).type), *zip(names, kinds)])
            for conv, piece, begin, end, learned in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_piece(piece)
                state[1] += 1
                state[2].update(role + b"\n" + text + b"\n")
                if learned:
                    masked = ESCAPED.sub(rb"\1", piece[begin:end])
                    state[3] += characters(masked)
                    state[4].update(masked)
                state[5] += characters(piece)
            yield flushed()
        if state:
            close()
            yield flushed()

    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.select("conv_id", "piece", "text_from", "text_to", "learned").mapInArrow(run, f"conv_id {kind}, {READ}")
