"""Append-only snapshot datasets: ``{root}/{name}/snapshot=YYYYMMDD_HHMMSS/part-*.parquet``.

Single files named ``{name}_{YYYYMMDD_HHMMSS}.parquet`` in the same folder are
read as snapshots too.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.errors import NothingToWrite
from spendlake.schemas import GOLD_TABLES
from spendlake.sources.drift import read_drifting
from spendlake.sources.scratch import remove_path

STAMP_FORMAT = "%Y%m%d_%H%M%S"


@dataclass(frozen=True)
class Written:
    """A snapshot that was written: where, and how many rows."""

    path: str
    rows: int


def stamp(at: datetime | None = None) -> str:
    return (at or datetime.now()).strftime(STAMP_FORMAT)


def snapshot_path(root: str, name: str, at: datetime | None = None) -> str:
    return f"{root.rstrip('/')}/{name}/snapshot={stamp(at)}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _free_path(spark: SparkSession, path: str) -> str:
    """The path or, where there is something already, the next one that sorts behind it."""
    for attempt in range(1, 100):
        free = path if attempt == 1 else f"{path}_{attempt:02d}"
        fs, target = file_system(spark, free)
        if not fs.exists(target):
            return free
    raise RuntimeError(f"99 snapshots begin with {path}")


def free_snapshot(spark: SparkSession, root: str, name: str, at: datetime | None = None) -> str:
    """The path of a new snapshot, which does not exist yet."""
    return _free_path(spark, snapshot_path(root, name, at))


@dataclass(frozen=True)
class Commit:
    """What a snapshot's marker says of it: rows, files, their bytes, and when the newest was written (milliseconds)."""

    rows: int
    files: int
    bytes: int
    newest: int


def _data_files(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Bytes and time (milliseconds) of each Parquet file below a folder."""
    fs, folder = file_system(spark, path)
    found, files = fs.listFiles(folder, True), []
    while found.hasNext():
        entry = found.next()
        if entry.getPath().getName().endswith(".parquet"):
            files.append((entry.getLen(), entry.getModificationTime()))
    return files


def commit_snapshot(spark: SparkSession, path: str, rows: int) -> Commit:
    """Make a finished snapshot count, and note in its marker how large it is."""
    files = _data_files(spark, path)
    commit = Commit(rows, len(files), sum(size for size, _ in files), max((at for _, at in files), default=0))
    put_text(spark, f"{path}/_SUCCESS", json.dumps(asdict(commit)))
    return commit


def read_commit(spark: SparkSession, path: str) -> Commit | None:
    """What the marker of a snapshot says; None where there is no marker, or an empty one."""
    text = get_text(spark, f"{path}/_SUCCESS")
    return Commit(**json.loads(text)) if text else None


def put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = file_system(spark, path)
    stream = fs.create(target)
    stream.write(text.encode())
    stream.close()


def get_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def clustered(df: DataFrame, by: str) -> DataFrame:
    """``df`` in ranges of a column, sorted within each, so that a scan for a range skips files and row groups by their
    statistics. A value that many rows have is spread over several ranges."""
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartitionByRange(F.col(by), spread).sortWithinPartitions(by)


def write_snapshot(
    df: DataFrame, root: str, name: str, at: datetime | None = None, cluster_by: str | None = None
) -> Written:
    """Write ``df`` as a new snapshot, in one pass over it, ``clustered`` by a column if one is named.

    The write counts the rows, and only then the snapshot gets its commit marker; one without rows is removed and
    the call fails. A snapshot is never overwritten: a second one of the same second, or after a run that died, gets a
    name that sorts behind the first.
    """
    spark = df.sparkSession
    path = free_snapshot(spark, root, name, at)
    seen = Observation()
    arranged = df if cluster_by is None else clustered(df, cluster_by)
    observed = arranged.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    writer.mode("error").parquet(path)
    rows = seen.get["rows"]
    if not rows:
        remove_path(spark, path)
        raise NothingToWrite(f"nothing to write for {name!r}: the frame is empty")
    commit_snapshot(spark, path, rows)
    return Written(path, rows)


def write_gold_snapshot(df: DataFrame, root: str, table: str, at: datetime | None = None) -> Written:
    """As ``write_snapshot``, for the known gold tables only."""
    if table not in GOLD_TABLES:
        raise ValueError(f"unknown gold table {table!r}; expected one of {list(GOLD_TABLES)}")
    return write_snapshot(df, root, table, at)


def latest_snapshot(spark: SparkSession, root: str, name: str, kind: str = "snapshot") -> str | None:
    """Path of the snapshot (or the landing run, ``kind="landed"``) with the greatest name, or None.

    Only committed snapshots count: Spark leaves ``_SUCCESS`` behind a finished
    write, so a folder without it belongs to a job that is running or has died.
    """
    fs, folder = file_system(spark, f"{root.rstrip('/')}/{name}")
    if not fs.exists(folder):
        return None
    found: dict[str, tuple[str, bool]] = {}  # file name it stands for -> (path, is a folder of ours)
    for entry in fs.listStatus(folder):
        path, label = entry.getPath().toString(), entry.getPath().getName()
        if label.startswith(f"{kind}="):
            found[f"{name}_{label.removeprefix(f'{kind}=')}.parquet"] = (path, True)
        elif label.endswith(".parquet") and kind == "snapshot":
            found[label] = (path, False)
    for label in sorted(found, reverse=True):
        path, ours = found[label]
        if not ours or fs.exists(file_system(spark, f"{path}/_SUCCESS")[1]):
            return path
    return None


def _one_write(spark: SparkSession, path: str) -> bool:
    """Whether all files of a folder come from the one job that committed it, so that they have one schema."""
    fs, target = file_system(spark, path)
    if not fs.getFileStatus(target).isDirectory():
        return True
    commit = read_commit(spark, path)
    return commit is not None and commit.files == len(_data_files(spark, path))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a snapshot: in the given schema, or in its own.

    A folder that ``write_snapshot`` committed has one schema, which any footer tells. Where files came from elsewhere or
    were added since, the footers of all of them are compared (``read_drifting``).
    """
    if schema is None and not _one_write(spark, path):
        return read_drifting(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
