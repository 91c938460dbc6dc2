"""What several operators share: words, row keys, byte batches."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space between words, as a Java pattern.
GAP = r"[ \x09-\x0D]"
WORD = r"[^ \x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def bytes_of(name: str = "text") -> Column:
    return text_of(name).cast("binary")


def lower_ascii(text: Column) -> Column:
    """A-Z lowered, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string column, and where each row begins in them (one more entry than rows)."""
    wide = column.type in (pa.large_binary(), pa.large_string())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most_bytes`` in ``column`` each; a longer row is a part of its own."""
    if not batch.num_rows:
        return
    _, starts = byte_arrays(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(starts, starts[at] + most_bytes, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def sent[T](spark: SparkSession, value: T) -> Callable[[], T]:
    """Broadcast a value of proven size; tasks call the result to get it. Classes travel by value."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)
