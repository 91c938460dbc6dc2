"""Latest silver snapshots -> gold snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from spendlake.operators.aggregate import finish, in_order, metric_parts, shared_grain, sum_parts
from spendlake.operators.union import union_strict
from spendlake.plans.isolate import Results, each, log
from spendlake.schemas import GOLD_TABLES, KNOWN_SOURCES, METRICS
from spendlake.sources.scratch import remove_path, scratch_path
from spendlake.sources.snapshots import Written, latest_snapshot, read_snapshot, write_gold_snapshot


def latest_silver(spark: SparkSession, silver_root: str) -> DataFrame | None:
    """Union of every platform's latest silver snapshot; None if there is none."""
    paths = [latest_snapshot(spark, silver_root, name) for name in KNOWN_SOURCES]
    frames = [read_snapshot(spark, path) for path in paths if path is not None]
    return union_strict(frames) if frames else None


def roll_up(spark: SparkSession, silver: DataFrame) -> tuple[dict[str, DataFrame], str]:
    """All gold tables that ``silver`` has the columns for, from a single scan of it.

    Silver is summed once to the tables' shared grain and that much smaller table
    is written to scratch. The gold tables are rolled up from there, exactly,
    because the parts are additive. Returns the tables and the scratch path.
    """
    have = set(silver.columns)
    possible = [t for t, g in GOLD_TABLES.items() if have.issuperset((*g.keys, *METRICS))]
    if not possible:
        raise ValueError("silver lacks the columns of every gold table")
    grain = shared_grain(possible)
    path = scratch_path(spark, "totals")
    try:
        sum_parts(metric_parts(silver, grain), grain).write.parquet(path)
        totals = spark.read.parquet(path)
        tables = {t: finish(sum_parts(totals, GOLD_TABLES[t].keys), t) for t in possible}
        return {t: in_order(gold, t) for t, gold in tables.items()}, path
    except Exception:
        remove_path(spark, path)
        raise


def summarize_all(
    spark: SparkSession, silver_root: str, gold_root: str, at: datetime | None = None
) -> Results[Written]:
    """Write the three gold tables; None for a table that failed, for all without silver."""
    at = at or datetime.now()
    try:
        silver = latest_silver(spark, silver_root)
        if silver is None:
            log.error("summarize | no silver rows below %s", silver_root)
            return Results(dict.fromkeys(GOLD_TABLES), skipped=dict.fromkeys(GOLD_TABLES, "no silver"))
        tables, scratch = roll_up(spark, silver)
    except Exception as error:  # no table can be built
        log.error("summarize | failed: %s", error)
        return Results(dict.fromkeys(GOLD_TABLES), errors=dict.fromkeys(GOLD_TABLES, str(error).split("\n\tat ")[0]))

    def write(table: str) -> Written | None:
        if table not in tables:
            raise ValueError(f"silver lacks columns for {table}")
        return write_gold_snapshot(tables[table], gold_root, table, at)

    try:
        return each(spark, "summarize", GOLD_TABLES, write)
    finally:
        remove_path(spark, scratch)
