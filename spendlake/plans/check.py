"""Quality run over the latest silver snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators.quality import REPORT_SCHEMA, quality_report, unreadable_report
from spendlake.plans.isolate import Results, each
from spendlake.schemas import KNOWN_SOURCES
from spendlake.sources.snapshots import latest_snapshot, read_snapshot


def check_file(spark: SparkSession, path: str) -> DataFrame:
    """The report of one silver snapshot; a file that cannot be read gives a failed report.

    The report is computed here: a damaged file shows only when it is scanned.
    It has 18 rows, which come back as a local frame.
    """
    try:
        rows = quality_report(read_snapshot(spark, path), path).collect()
    except Exception as error:  # whatever went wrong, it is the report of this file
        return unreadable_report(spark, path, str(error).split("\n\tat ")[0])
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def check(spark: SparkSession, silver_root: str) -> Results[DataFrame]:
    """Reports of every platform's latest silver snapshot; None where there is none."""

    def report(name: str) -> DataFrame | None:
        path = latest_snapshot(spark, silver_root, name)
        return check_file(spark, path) if path else None

    return each(spark, "check", KNOWN_SOURCES, report)


def reports_by_source(reports: dict[str, DataFrame | None]) -> DataFrame | None:
    """All reports as one frame, keyed by source instead of by path."""
    frames = [r.withColumn("source_file", F.lit(name)) for name, r in reports.items() if r is not None]
    return reduce(DataFrame.unionByName, frames) if frames else None
