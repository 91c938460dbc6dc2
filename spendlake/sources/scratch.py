"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables, below ``spark.checkpoint.dir``, else below the warehouse.

    On a cluster executors do not share a local warehouse, so there the setting is needed.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        target = spark._jvm.org.apache.hadoop.fs.Path(shared)
        scheme = target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
        if scheme == "file" and not spark.sparkContext._jsc.sc().isLocal():
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return f"{shared.rstrip('/')}/spendlake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``scratch_root``."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: later reads neither compute it again nor need the executors that did."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove one path on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; for its end, when no frame that reads one is left."""
    remove_path(spark, scratch_root(spark))
