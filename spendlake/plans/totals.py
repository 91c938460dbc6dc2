"""Gold that follows restated days: additive totals are kept, and only changed days are summed again.

The totals of the grain all gold tables share, (date, source, campaign), are a table in buckets of days (``sources.buckets``).
Costs are kept in parts that add up exactly (``functions.cost``), so gold rolled up from it has the same bits as gold summed
from all silver rows at once, in whatever order days came in.

A batch restates every day of a source that it has rows of, or all days of a window: those totals are replaced, all others
stay. Only the batch and the buckets of its days are read; the rest of silver is not needed any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions.cost import COST_PARTS
from spendlake.functions.dates import check_window
from spendlake.operators.aggregate import COUNTERS, finish, in_order, metric_parts, shared_grain, sum_parts
from spendlake.plans.isolate import Results, each
from spendlake.plans.summarize import latest_silver
from spendlake.schemas import GOLD_TABLES, SILVER_SCHEMA
from spendlake.sources.buckets import BucketedTable, Manifest, commit, read_buckets, read_manifest, touched, write_buckets
from spendlake.sources.scratch import remove_path, scratch_path
from spendlake.sources.snapshots import Written, stamp, write_gold_snapshot

NAME = "totals"
GRAIN = tuple(shared_grain(GOLD_TABLES))
DAY = ("date", "source")
TOTALS_SCHEMA = T.StructType(
    [SILVER_SCHEMA[k] for k in GRAIN]
    + [T.StructField(c, T.LongType()) for c in COUNTERS]
    + [T.StructField(c, T.DoubleType() if c in ("cost_rest", "cost_loose") else T.LongType()) for c in COST_PARTS]
)
DEFAULT_BUCKETS = 64


def totals(spark: SparkSession, root: str, manifest: Manifest | None = None) -> DataFrame:
    """The totals of every day, source and campaign, as additive parts."""
    manifest = manifest or read_manifest(spark, root)
    return read_buckets(spark, root, NAME, manifest.tables.get(NAME) or BucketedTable(DEFAULT_BUCKETS, ("date",)), TOTALS_SCHEMA)


def gold_from(parts: DataFrame) -> dict[str, DataFrame]:
    """All gold tables from totals, each in its order."""
    return {t: in_order(finish(sum_parts(parts, g.keys), t), t) for t, g in GOLD_TABLES.items()}


def restate(
    spark: SparkSession,
    silver: DataFrame,
    root: str,
    at: datetime | None = None,
    window: tuple[date, date] | None = None,
    buckets: int = DEFAULT_BUCKETS,
) -> Manifest:
    """Replace the totals of the days that ``silver`` has rows of, by source, and commit that.

    With a window, every day in it is replaced for the sources in ``silver``, also one that has no rows any more; rows
    outside are refused. A restated day and its totals are read and written in one pass; another writer's commit in
    between fails this one.
    """
    at = at or datetime.now()
    root = root.rstrip("/")
    manifest = read_manifest(spark, root)
    table = manifest.tables.get(NAME) or BucketedTable(buckets, ("date",))
    path = scratch_path(spark, NAME)
    try:
        sum_parts(metric_parts(silver, GRAIN), GRAIN).write.parquet(path)
        fresh = spark.read.schema(TOTALS_SCHEMA).parquet(path)
        days = fresh.select(*DAY).distinct()
        if window is not None:
            check_window(*window, max_days=None)
            outside = days.where(F.col("date").isNull() | ~F.col("date").between(*map(F.lit, window))).first()
            if outside is not None:
                raise ValueError(f"{outside['source']} has rows of {outside['date']}, outside the window {window[0]}..{window[1]}")
            spine = "explode(sequence(DATE'{}', DATE'{}')) AS date".format(*window)
            days = fresh.select("source").distinct().selectExpr(spine, "source")
        changed = touched(days, table)
        if not changed:
            return manifest
        named = days.select(*[F.col(c).alias(f"new_{c}") for c in DAY])
        old = read_buckets(spark, root, NAME, table, TOTALS_SCHEMA, changed)
        same = [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in DAY]
        kept = old.join(named, same[0] & same[1], "left_anti")
        load = f"{stamp(at)}-{uuid.uuid4().hex[:8]}"
        table = write_buckets(kept.unionByName(fresh), root, NAME, table, changed, load)
        return commit(spark, root, replace(manifest, tables=manifest.tables | {NAME: table}))
    finally:
        remove_path(spark, path)


def summarize_restated(
    spark: SparkSession,
    silver_root: str,
    totals_root: str,
    gold_root: str,
    at: datetime | None = None,
    window: tuple[date, date] | None = None,
) -> Mapping[str, Written | None]:
    """Restate the days of the latest silver snapshots and write the three gold tables of all days; None for one that failed."""
    at = at or datetime.now()
    silver = latest_silver(spark, silver_root)
    if silver is None:
        return Results(dict.fromkeys(GOLD_TABLES), skipped=dict.fromkeys(GOLD_TABLES, "no silver"))
    tables = gold_from(totals(spark, totals_root, restate(spark, silver, totals_root, at, window)))
    return each(spark, "summarize", GOLD_TABLES, lambda t: write_gold_snapshot(tables[t], gold_root, t, at))
