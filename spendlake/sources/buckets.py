"""Served tables in buckets of their keys, and the manifest that says which files make them up.

    {root}/_manifest/0000000012.json                       what the tables consist of, one file a version
    {root}/gold_daily_summary/load=…/bucket=7/part-*.parquet

A row's bucket is a hash of key columns. A load reads and writes only the buckets that its batch has keys of; all others
keep the files they have. Files are never changed: a load writes a folder of its own and then, as its last step, a manifest
that names for every table the load each bucket is to be read from. So all tables change at once, a load that dies changes
nothing, and whoever reads keeps the version begun with. A manifest's number is one above that of the version its writer has
read, and its file has to be new, so of two writers that began from the same version the second one fails.

That takes a store whose rename is atomic and refuses an existing target, as HDFS and ABFS do. A local disk checks before it
renames, which is good enough for one writer at a time. The manifest has
one number a bucket, whatever the size of the tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendlake.errors import StaleWriter
from spendlake.sources.scratch import remove_path
from spendlake.sources.snapshots import file_system

MANIFESTS = "_manifest"


@dataclass(frozen=True)
class BucketedTable:
    """The number of buckets, the columns that choose one, and the load that holds each bucket with rows."""

    buckets: int
    by: tuple[str, ...]
    loads: dict[int, str] = field(default_factory=dict)

    def bucket(self) -> str:
        """The bucket of a row, as SQL."""
        return f"cast(pmod(xxhash64({', '.join(self.by)}), {self.buckets}) AS int)"


@dataclass(frozen=True)
class Manifest:
    """One version of all tables. Version 0 has none."""

    version: int = 0
    tables: dict[str, BucketedTable] = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {}
        for name, table in self.tables.items():
            held: dict[str, list[int]] = {}
            for bucket, load in sorted(table.loads.items()):
                held.setdefault(load, []).append(bucket)
            tables[name] = {"buckets": table.buckets, "by": table.by, "loads": held}
        return json.dumps({"version": self.version, "tables": tables})

    @staticmethod
    def from_json(text: str) -> Manifest:
        found = json.loads(text)
        tables = {
            name: BucketedTable(t["buckets"], tuple(t["by"]), {b: load for load, held in t["loads"].items() for b in held})
            for name, t in found["tables"].items()
        }
        return Manifest(found["version"], tables)


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, folder = file_system(spark, f"{root}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _manifest_path(root: str, version: int) -> str:
    return f"{root}/{MANIFESTS}/{version:010d}.json"


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest version, or a given one."""
    versions = _versions(spark, root)
    if version is None and not versions:
        return Manifest()
    fs, path = file_system(spark, _manifest_path(root, versions[-1] if version is None else version))
    stream = fs.open(path)
    try:
        return Manifest.from_json(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, manifest: Manifest) -> Manifest:
    """Make ``manifest``, changed since it was read, the next version. Fails if somebody else has been faster."""
    new = replace(manifest, version=manifest.version + 1)
    target = _manifest_path(root, new.version)
    fs, temporary = file_system(spark, f"{root}/{MANIFESTS}/.{uuid.uuid4().hex}")
    stream = fs.create(temporary)
    stream.write(new.to_json().encode())
    stream.close()
    files = spark._jvm.org.apache.hadoop.fs
    context = files.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(files, "Options$Rename"), 0)
    try:
        context.rename(temporary, file_system(spark, target)[1], no_options)
    except Py4JJavaError as error:
        fs.delete(temporary, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise StaleWriter(root, manifest.version) from None
        raise
    return new


def bucket_path(root: str, name: str, load: str, bucket: int) -> str:
    return f"{root}/{name}/load={load}/bucket={bucket}"


def read_buckets(
    spark: SparkSession, root: str, name: str, table: BucketedTable, schema: T.StructType, only: Iterable[int] | None = None
) -> DataFrame:
    """The rows of a table, or of some of its buckets."""
    chosen = sorted(table.loads if only is None else table.loads.keys() & set(only))
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[bucket_path(root, name, table.loads[b], b) for b in chosen])


def touched(batch: DataFrame, table: BucketedTable) -> list[int]:
    """The buckets that a batch has keys of; at most as many values as there are buckets."""
    return sorted(r[0] for r in batch.selectExpr(f"{table.bucket()} AS bucket").distinct().collect())


def write_buckets(rows: DataFrame, root: str, name: str, table: BucketedTable, buckets: Iterable[int], load: str) -> BucketedTable:
    """Write ``rows``, all those of some buckets, as a load of its own; the table with these buckets read from there.

    Rows are dealt by bucket before the write, so a bucket is one file. A bucket without rows is read from nowhere.
    """
    chosen = set(buckets)
    dealt = rows.selectExpr("*", f"{table.bucket()} AS bucket").repartition(max(len(chosen), 1), "bucket")
    dealt.write.partitionBy("bucket").mode("error").parquet(f"{root}/{name}/load={load}")
    fs, folder = file_system(rows.sparkSession, f"{root}/{name}/load={load}")
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    written = {int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket=")}
    others = {bucket: held for bucket, held in table.loads.items() if bucket not in chosen}
    return replace(table, loads=others | dict.fromkeys(written, load))


def prune(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove the files that none of the newest ``keep`` versions is made of, and older manifests; returns how many folders went.

    Not while a load is running: the files of one that has not committed are named by no version either.
    """
    versions = _versions(spark, root)
    kept = [read_manifest(spark, root, v) for v in versions[-keep:]]
    used = {bucket_path(root, n, load, b) for m in kept for n, t in m.tables.items() for b, load in t.loads.items()}
    names = {n for m in kept for n in m.tables}
    removed = 0
    for name in names:
        fs, folder = file_system(spark, f"{root}/{name}")
        for load in fs.listStatus(folder) if fs.exists(folder) else []:
            left = 0
            for bucket in fs.listStatus(load.getPath()):
                label = bucket.getPath().getName()
                if not label.startswith("bucket="):
                    continue
                if f"{root}/{name}/{load.getPath().getName()}/{label}" in used:
                    left += 1
                else:
                    fs.delete(bucket.getPath(), True)
                    removed += 1
            if not left:
                fs.delete(load.getPath(), True)
    for version in versions[:-keep]:
        remove_path(spark, _manifest_path(root, version))
    return removed
