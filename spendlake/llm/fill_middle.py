"""Fill-in-the-middle transformation over a sparse exception index.

A text is cut into units, a run of ASCII letters or any other single character. Hashes of the id choose two cuts between
units; the parts are written in the order prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``), each behind
its mark. Empty texts, texts that hold a mark and a share of all texts stay as they are (``plain``).

Cuts are found in bytes and reported in code points. Only characters of several bytes are exceptions to "one byte, one
character": the index holds their positions and the excess bytes up to each, so a conversion is one ``searchsorted`` plus
arithmetic, and plain ASCII needs no index entry at all. It is built once for all texts of a batch. Units are counted in
blocks, so that no array is wider than a byte per byte of text.

Null text: empty. Null id: hashed as an empty one. Repeated rows are each returned; other columns are ignored; no rows, no
rows. A very long text is a batch of its own and takes a few times its size in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import byte_arrays, bytes_of, slices

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLOCK = 4096

OUTPUT = "n long, form string, prefix_chars long, middle_chars long, output string"


class ExceptionIndex:
    """Byte positions and code points of UTF-8 data; only characters of several bytes are recorded."""

    def __init__(self, data: np.ndarray):
        self.bytes = np.flatnonzero(data >= 0xC0)
        first = data[self.bytes]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])  # of all exceptions before each, and of all
        self.chars = self.bytes - self.excess[:-1]

    def char_of(self, byte: np.ndarray) -> np.ndarray:
        """How many characters stand before byte positions that lie between characters."""
        return byte - self.excess[np.searchsorted(self.bytes, byte)]

    def byte_of(self, char: np.ndarray) -> np.ndarray:
        """The byte positions at which characters begin."""
        return char + self.excess[np.searchsorted(self.chars, char)]


class Units:
    """Where units begin in the texts of a batch, numbered through the batch."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        letter = (data | 0x20) - np.uint8(ord("a")) < 26
        self.begins = (data < 0x80) | (data >= 0xC0)
        self.begins[1:] &= ~(letter[1:] & letter[:-1])
        self.begins[starts[:-1][np.diff(starts) > 0]] = True
        counts = np.add.reduceat(self.begins, np.arange(0, len(data), BLOCK), dtype=np.int64) if len(data) else []
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def rank(self, byte: int) -> int:
        """How many units begin before a byte."""
        block = byte // BLOCK
        return int(self.before[block]) + int(np.count_nonzero(self.begins[block * BLOCK : byte]))

    def byte_of(self, unit: int) -> int:
        """Where a unit begins; the end of the data for one beyond the last."""
        block = int(np.searchsorted(self.before, unit, side="right")) - 1
        if block == len(self.before) - 1:
            return len(self.begins)
        inside = np.flatnonzero(self.begins[block * BLOCK : (block + 1) * BLOCK])
        return block * BLOCK + int(inside[unit - int(self.before[block])])


def transform_batch(texts: pa.Array, draws: list[tuple[int, int, int, int]], fim_percent: int, spm_percent: int) -> pa.RecordBatch:
    """The columns of ``OUTPUT`` for texts (binary) and four random numbers each."""
    data, starts = byte_arrays(texts)
    index, units, view = ExceptionIndex(data), Units(data, starts), memoryview(data)
    ranks = [units.rank(at) for at in starts.tolist()]
    rows, cuts = [], []
    for row, (h1, h2, h3, h4) in enumerate(draws):
        begin, end, first = int(starts[row]), int(starts[row + 1]), ranks[row]
        n, text = ranks[row + 1] - first, view[begin:end]
        whole = bytes(text)
        if not n or h3 % 100 >= fim_percent or PREFIX in whole or SUFFIX in whole or MIDDLE in whole:
            rows.append((n, "plain", whole))
            cuts.append((begin, begin, begin))
            continue
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (min(units.byte_of(first + k), end) for k in (low, high))
        prefix, middle, suffix = view[begin:a], view[a:b], view[b:end]
        if h4 % 100 < spm_percent:
            rows.append((n, "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))))
        else:
            rows.append((n, "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))))
        cuts.append((begin, a, b))
    chars = np.diff(index.char_of(np.array(cuts, np.int64).reshape(-1, 3)), axis=1)
    plain = np.array([form == "plain" for _, form, _ in rows], bool)
    n, form, made = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(n, pa.int64()),
            pa.array(form, pa.string()),
            pa.array(chars[:, 0], pa.int64(), mask=plain),
            pa.array(chars[:, 1], pa.int64(), mask=plain),
            pa.array(made, pa.binary()).cast(pa.string()),
        ],
        ["n", "form", "prefix_chars", "middle_chars", "output"],
    )


def _draws(seed: int) -> list[Column]:
    """Four numbers of 32 bits from a hash of the seed and the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """Of every row of (doc_id, text): doc_id, number of units, form, code points of prefix and middle, and the output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                draws = list(zip(*(batch.column(f"h{i}").to_pylist() for i in (1, 2, 3, 4))))
                made = transform_batch(batch.column("text"), draws, fim_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.columns], ["doc_id", *made.schema.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *_draws(seed), bytes_of().alias("text")).mapInArrow(run, f"doc_id {kind}, {OUTPUT}")


def restored(output: bytes, form: str) -> bytes:
    """The text that an output was made of. A mark cannot begin inside a part and end in the next mark."""
    if form == "plain":
        return output
    if form == "spm":
        suffix, rest = output[len(SUFFIX) :].split(PREFIX, 1)
        prefix, middle = rest.split(MIDDLE, 1)
    else:
        prefix, rest = output[len(PREFIX) :].split(SUFFIX, 1)
        suffix, middle = rest.split(MIDDLE, 1)
    return prefix + middle + suffix


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` with ``restored``, the text rebuilt from ``output`` and ``form`` alone."""
    names = [*transformed.columns, "restored"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__bytes"):
                pairs = zip(batch.column("__bytes").to_pylist(), batch.column("form").to_pylist())
                texts = pa.array([restored(o, f) for o, f in pairs], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema.fields)
    return transformed.withColumn("__bytes", F.col("output").cast("binary")).mapInArrow(run, f"{schema}, restored string")


def digest(docs: DataFrame) -> DataFrame:
    """What the transformation did, with hashes of the output and of the text rebuilt from it."""
    return restore(fill_in_middle(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        *[F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")],
    )
