"""Latest gold snapshots -> served tables in buckets, all of them in one commit.

Unlike ``plans.serve``, which rewrites a table at each load and loads the tables one by one, a load touches only the buckets
it has keys of, and readers see either none of its tables or all.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from spendlake.operators.merge import empty_served, merge
from spendlake.plans.serve import served_name
from spendlake.schemas import GOLD_TABLES, ServedTypes, gold_table, served_schema
from spendlake.sources.buckets import BucketedTable, Manifest, commit, read_buckets, read_manifest, touched, write_buckets
from spendlake.sources.snapshots import latest_snapshot, read_snapshot, stamp

# A restated day is one bucket of the daily table. Campaigns are spread by their whole key: a source may hold most of them.
BUCKETED_BY = {"daily_summary": ("date",), "campaign_summary": ("source", "campaign_name"), "source_comparison": ("source",)}
DEFAULT_BUCKETS = 64


def served_version(
    spark: SparkSession, root: str, table: str, types: ServedTypes = ServedTypes(), manifest: Manifest | None = None
) -> DataFrame:
    """A served table as of a manifest, the newest one if none is given. Tables read with one manifest belong together."""
    manifest = manifest or read_manifest(spark, root)
    gold_table(table)
    state = manifest.tables.get(served_name(table))
    if state is None:
        return empty_served(spark, table, types)
    return read_buckets(spark, root, served_name(table), state, served_schema(table, types))


def upsert_buckets(
    spark: SparkSession,
    root: str,
    table: str,
    batch: DataFrame,
    state: BucketedTable,
    at: datetime,
    types: ServedTypes = ServedTypes(),
) -> tuple[BucketedTable, int]:
    """Merge ``batch`` into the buckets it has keys of; the state that reads the result, and the rows of the batch.

    Nothing is visible before the state is committed. A key that is NULL or occurs twice fails, as in any merge.
    """
    name, rows = served_name(table), batch.count()
    if not rows:
        return state, 0
    # The bucket of a served key and that of the same gold key are equal: keys have the same types in both.
    buckets = touched(batch, state)
    target = read_buckets(spark, root, name, state, served_schema(table, types), buckets)
    merged = merge(target, batch, table, at, types)
    return write_buckets(merged, root, name, state, buckets, f"{stamp(at)}-{uuid.uuid4().hex[:8]}"), rows


def serve_together(
    spark: SparkSession,
    gold_root: str,
    serve_root: str,
    at: datetime | None = None,
    types: ServedTypes = ServedTypes(),
    buckets: int = DEFAULT_BUCKETS,
) -> dict[str, int]:
    """Load the latest gold snapshot of every table that has one, all or nothing; rows of each batch by table.

    ``buckets`` counts for tables that are loaded for the first time. Fails without changing anything if a table fails, or
    if another load has committed since this one began.
    """
    at = at or datetime.now()
    root = serve_root.rstrip("/")
    manifest, loaded = read_manifest(spark, root), {}
    tables = dict(manifest.tables)
    for table in GOLD_TABLES:
        path = latest_snapshot(spark, gold_root, table)
        if path is None:
            continue
        state = tables.get(served_name(table)) or BucketedTable(buckets, BUCKETED_BY[table])
        tables[served_name(table)], loaded[table] = upsert_buckets(spark, root, table, read_snapshot(spark, path), state, at, types)
    if any(loaded.values()):
        commit(spark, root, replace(manifest, tables=tables))
    return loaded
