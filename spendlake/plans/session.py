"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the reduce side from what was really shuffled, splits skewed join
# partitions and picks broadcast joins by measured size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def session(name: str = "spendlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; the cluster's own configuration gives the rest."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
