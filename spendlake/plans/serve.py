"""Latest gold snapshots -> served tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from spendlake.operators.merge import empty_served, merge
from spendlake.plans.isolate import Results, each
from spendlake.schemas import GOLD_TABLES, ServedTypes, gold_table, served_schema
from spendlake.sources.snapshots import latest_snapshot, read_snapshot, write_snapshot


def served_name(table: str) -> str:
    return f"gold_{table}"


def served(
    spark: SparkSession, serve_root: str, table: str, types: ServedTypes = ServedTypes()
) -> DataFrame:
    """A served table as it stands; empty before its first load."""
    schema = served_schema(table, types)
    path = latest_snapshot(spark, serve_root, served_name(table))
    return read_snapshot(spark, path, schema) if path else empty_served(spark, table, types)


def upsert(
    spark: SparkSession,
    serve_root: str,
    table: str,
    batch: DataFrame,
    at: datetime | None = None,
    types: ServedTypes = ServedTypes(),
) -> int:
    """Merge ``batch`` into a served table and return its row count.

    The result is a new snapshot: the one being read stays as it is, and readers
    move over when the write has committed.
    """
    gold_table(table)
    rows = batch.count()
    if rows == 0:
        return 0
    at = at or datetime.now()
    merged = merge(served(spark, serve_root, table, types), batch, table, at, types)
    write_snapshot(merged, serve_root, served_name(table), at)
    return rows


def serve_all(
    spark: SparkSession,
    gold_root: str,
    serve_root: str,
    at: datetime | None = None,
    types: ServedTypes = ServedTypes(),
) -> Results[int]:
    """Load every table's latest gold snapshot; None where there is none or the load failed."""

    def load(table: str) -> int | None:
        path = latest_snapshot(spark, gold_root, table)
        if path is None:
            return None
        return upsert(spark, serve_root, table, read_snapshot(spark, path), at, types)

    return each(spark, "serve", GOLD_TABLES, load)
