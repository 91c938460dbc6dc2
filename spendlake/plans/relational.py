"""Gold tables -> a relational store that knows INSERT .. ON CONFLICT (PostgreSQL).

Spark's JDBC writer only appends or replaces. The batch is therefore written to a
staging table, by all tasks in parallel, and one statement of the store merges it
into the served table in a single transaction.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendlake.operators.merge import as_served, one_per_key
from spendlake.plans.isolate import Results, each
from spendlake.plans.serve import served_name
from spendlake.schemas import GOLD_TABLES, SERVED_TEXT_LENGTH, ServedTypes, gold_table, served_schema
from spendlake.sources.snapshots import latest_snapshot, read_snapshot


def _sql_type(field: T.StructField) -> str:
    if isinstance(field.dataType, T.DecimalType):
        return f"NUMERIC({field.dataType.precision}, {field.dataType.scale})"
    if isinstance(field.dataType, T.StringType):
        return f"VARCHAR({SERVED_TEXT_LENGTH[field.name]})"
    return {"date": "DATE", "bigint": "BIGINT"}[field.dataType.simpleString()]


def create_statement(table: str, types: ServedTypes = ServedTypes()) -> str:
    """Create a served table unless it exists."""
    name, keys = served_name(table), ", ".join(gold_table(table).keys)
    columns = [f"{f.name} {_sql_type(f)} NOT NULL" for f in served_schema(table, types).fields[:-1]]
    columns.append("loaded_at TIMESTAMP DEFAULT now()")
    columns.append(f"CONSTRAINT pk_{name} PRIMARY KEY ({keys})")
    return f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)})"


def merge_statement(table: str, staging: str) -> str:
    """Insert the staged rows; on a key that exists, overwrite the metrics but not ``loaded_at``."""
    spec = gold_table(table)
    columns = ", ".join(spec.columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in spec.columns if c not in spec.keys)
    return (
        f"INSERT INTO {served_name(table)} ({columns}) SELECT {columns} FROM {staging} "
        f"ON CONFLICT ({', '.join(spec.keys)}) DO UPDATE SET {updates}"
    )


def staged_rows(batch: DataFrame, table: str, types: ServedTypes = ServedTypes()) -> DataFrame:
    """The batch in the served types; a NULL, an overflow or a double key fails the job."""
    return one_per_key(as_served(batch, table, types), gold_table(table).keys)


def _in_one_transaction(
    spark: SparkSession, url: str, properties: dict[str, str], statements: list[str]
) -> list[int]:
    """Run statements on the driver's connection; returns the row count of each."""
    jvm = spark.sparkContext._jvm
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        counts = [connection.createStatement().executeUpdate(s) for s in statements]
        connection.commit()
        return counts
    finally:
        connection.close()


def upsert_relational(
    batch: DataFrame,
    table: str,
    url: str,
    properties: dict[str, str],
    types: ServedTypes = ServedTypes(),
    connections: int = 16,
) -> int:
    """Merge ``batch`` into the store's served table; returns the number of merged rows.

    Each load has a staging table of its own, so loads of one table do not mix, and
    a failed one can simply be repeated. ``connections`` bounds how many tasks write at once.
    """
    spark, staging = batch.sparkSession, f"{served_name(table)}_staging_{uuid.uuid4().hex[:12]}"
    rows, settings = staged_rows(batch, table, types), properties | {"numPartitions": str(connections)}
    rows.write.jdbc(url, staging, mode="error", properties=settings)
    statements = [create_statement(table, types), merge_statement(table, staging), f"DROP TABLE {staging}"]
    return _in_one_transaction(spark, url, properties, statements)[1]


def serve_relational(
    spark: SparkSession,
    gold_root: str,
    url: str,
    properties: dict[str, str] | None = None,
    types: ServedTypes = ServedTypes(),
) -> Results[int]:
    """Load every table's latest gold snapshot into the store; None where there is none or the load failed."""

    def load(table: str) -> int | None:
        path = latest_snapshot(spark, gold_root, table)
        return upsert_relational(read_snapshot(spark, path), table, url, properties or {}, types) if path else None

    return each(spark, "serve", GOLD_TABLES, load)
