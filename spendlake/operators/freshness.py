"""Freshness of the layers, from a listing of their files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions.casts import rounded

# Fixed value: hours after which a layer is stale.
MAX_AGE_HOURS = 25
LAYERS = ("bronze", "silver", "gold")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below ``path``: ``path, modified_at, bytes``.

    The binaryFile source lists without opening a file as long as ``content`` is
    not selected, and it sees files that hold no rows.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes"))
    )


def _with_verdict(aged: DataFrame) -> DataFrame:
    stale = f"age_hours > {MAX_AGE_HOURS}"
    return aged.selectExpr(
        "*",
        f"coalesce(NOT {stale}, false) AS ok",
        f"""CASE WHEN age_hours IS NULL THEN 'no parquet files'
                 WHEN {stale} THEN concat('latest file is ', age_hours, 'h old')
                 ELSE 'ok' END AS message""",
    )


def age_hours(modified_at: Column, as_of: datetime | Column) -> Column:
    """Hours between two timestamps, to one decimal."""
    micros = F.unix_micros(F.lit(as_of)) - F.unix_micros(modified_at)
    return F.rint(micros / 3600e6 * 10) / 10


def freshness(
    files: DataFrame, by: Sequence[str], as_of: datetime | Column, newest: bool = False
) -> DataFrame:
    """One row per group of files: its latest file, that file's age, and a verdict.

    The latest file is the one with the greatest path or, with ``newest``, the one
    modified last. ``by`` names the columns to group by, such as ``layer``.
    """
    order = F.struct("modified_at", "path") if newest else F.struct("path", "modified_at")
    latest = files.groupBy(*by).agg(F.max(order).alias("latest"))
    aged = latest.select(
        *by,
        F.regexp_extract("latest.path", r"([^/]+)$", 1).alias("latest_file"),
        age_hours(F.col("latest.modified_at"), as_of).alias("age_hours"),
    )
    return _with_verdict(aged)


def with_missing_layers(status: DataFrame, layers: Sequence[str] = LAYERS) -> DataFrame:
    """The status with a row for every layer; a layer without files is not ok."""
    expected = status.sparkSession.createDataFrame([(name,) for name in layers], "layer string")
    return _with_verdict(expected.join(status.drop("ok", "message"), "layer", "left"))


def overall_status(status: DataFrame) -> DataFrame:
    """``healthy`` if every component is ok, else ``degraded``."""
    healthy = F.coalesce(F.bool_and("ok"), F.lit(False))
    return status.agg(
        F.when(healthy, "healthy").otherwise("degraded").alias("status"),
        F.count_if("ok").alias("components_ok"),
        F.count(F.lit(1)).alias("components"),
    )


def size_kb(files: DataFrame) -> DataFrame:
    """Total size of the listed files in KB, to two decimals."""
    return files.agg(F.expr(f"{rounded('coalesce(sum(bytes), 0) / 1024', 2)} AS size_kb"))
