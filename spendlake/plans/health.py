"""Health of a storage root: are all three layers fresh?"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators.freshness import LAYERS, freshness, list_files, with_missing_layers
from spendlake.sources.snapshots import file_system, latest_snapshot, read_commit


def _datasets(spark: SparkSession, folder: str) -> list[str]:
    fs, path = file_system(spark, folder)
    return sorted(e.getPath().getName() for e in fs.listStatus(path) if e.isDirectory()) if fs.exists(path) else []


def layer_files(spark: SparkSession, storage_root: str) -> DataFrame | None:
    """The Parquet files of each dataset's latest snapshot, with their layer and dataset.

    Of the older snapshots only the names are listed.
    """
    frames = []
    for layer in LAYERS:
        root = f"{storage_root.rstrip('/')}/{layer}"
        for dataset in _datasets(spark, root):
            path = latest_snapshot(spark, root, dataset)
            if path is not None:
                names = F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset")
                frames.append(list_files(spark, path).select(*names, "path", "modified_at", "bytes"))
    return reduce(DataFrame.unionByName, frames) if frames else None


COMMITS = "layer string, dataset string, path string, rows long, files long, bytes long, modified_at timestamp"


def commits(spark: SparkSession, storage_root: str) -> DataFrame:
    """One row per dataset: what the marker of its latest snapshot says. No file is listed, but those of snapshots whose
    marker is empty, as Spark itself leaves it; their rows are not known."""
    found = []
    for layer in LAYERS:
        root = f"{storage_root.rstrip('/')}/{layer}"
        for dataset in _datasets(spark, root):
            path = latest_snapshot(spark, root, dataset)
            commit = path and read_commit(spark, path)
            if commit:
                found.append((layer, dataset, path, commit.rows, commit.files, commit.bytes, datetime.fromtimestamp(commit.newest / 1000)))
            elif path:
                listed = list_files(spark, path).agg(F.count("*"), F.sum("bytes"), F.max("modified_at")).first()
                found.append((layer, dataset, path, None, *listed))
    return spark.createDataFrame(found, COMMITS)


def committed_health(spark: SparkSession, storage_root: str, as_of: datetime | None = None) -> DataFrame:
    """As ``dataset_health``, from the markers: the latest file is the snapshot. Also its rows, files and bytes."""
    known = commits(spark, storage_root)
    status = freshness(known, ["layer", "dataset"], as_of or datetime.now(), newest=True)
    return status.join(known.select("layer", "dataset", "rows", "files", "bytes"), ["layer", "dataset"])


def layer_health(spark: SparkSession, storage_root: str, as_of: datetime | None = None) -> DataFrame:
    """One row per layer: its latest file by name, the file's age, and whether that is ok."""
    as_of = as_of or datetime.now()
    files = layer_files(spark, storage_root)
    if files is None:
        files = spark.createDataFrame([], "layer string, path string, modified_at timestamp")
    return with_missing_layers(freshness(files, ["layer"], as_of))


def dataset_health(spark: SparkSession, storage_root: str, as_of: datetime | None = None) -> DataFrame | None:
    """As ``layer_health`` per dataset, and by modification time: no dataset hides another."""
    files = layer_files(spark, storage_root)
    if files is None:
        return None
    return freshness(files, ["layer", "dataset"], as_of or datetime.now(), newest=True)
