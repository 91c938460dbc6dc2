"""Run metrics, kept as rows of an ordinary table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from spendlake.operators.freshness import list_files, size_kb
from spendlake.sources.snapshots import Written

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_at", T.TimestampNTZType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("item", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("items_ok", T.LongType(), False),
        T.StructField("items_failed", T.LongType(), False),
        T.StructField("rows_total", T.LongType(), False),
        T.StructField("duration_seconds", T.DoubleType(), False),
        T.StructField("error", T.StringType()),
    ]
)


def append_run(
    spark: SparkSession,
    log_path: str,
    stage: str,
    results: Mapping[str, Written | int | None],
    seconds: float,
    run_at: datetime,
) -> None:
    """Append one row per item of a finished stage: ok, failed with its error, or skipped for want of input."""
    errors, skipped = getattr(results, "errors", {}), getattr(results, "skipped", {})
    counts = {
        item: result.rows if isinstance(result, Written) else result for item, result in results.items()
    }
    done = [c for c in counts.values() if c is not None]
    rows = [
        (
            run_at,
            stage,
            item,
            "ok" if result is not None else "skipped" if item in skipped else "failed",
            counts[item],
            result.path if isinstance(result, Written) else None,
            len(done),
            len(counts) - len(done),
            sum(done),
            round(seconds, 2),
            errors.get(item) or skipped.get(item),
        )
        for item, result in results.items()
    ]
    spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)


def output_info(spark: SparkSession, written: Written | None) -> dict[str, str | float]:
    """Path, size and status of a stage's output."""
    if written is None:
        return {"status": "failed"}
    size = size_kb(list_files(spark, written.path)).first().size_kb
    return {"status": "ok", "path": written.path, "size_kb": size}
