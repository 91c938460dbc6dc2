"""Keyed merge into the served tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions.casts import or_fail
from spendlake.schemas import SERVED_TEXT_LENGTH, ServedTypes, gold_table, served_schema


def empty_served(spark: SparkSession, table: str, types: ServedTypes = ServedTypes()) -> DataFrame:
    """A served table with its declared types and no rows."""
    return spark.createDataFrame([], served_schema(table, types))


def _served_key(field: T.StructField, gold: DataFrame) -> tuple[str, str]:
    """A key column and the condition that it can be served. A key that has its type already stays as it is, so that
    what it is partitioned by is known further on."""
    name, limit = field.name, SERVED_TEXT_LENGTH.get(field.name)
    value = name if gold.schema[name].dataType == field.dataType else f"cast({name} AS {field.dataType.simpleString()})"
    failing = f"CASE WHEN {name} IS NULL THEN raise_error('served {name} is null')"
    if limit is not None:
        failing += f" WHEN length({name}) > {limit} THEN raise_error('served {name} (at most {limit} characters)')"
    return f"{value} AS {name}", f"{failing} ELSE true END"


def _served_value(field: T.StructField) -> str:
    name, kind = field.name, field.dataType.simpleString()
    value = f"try_cast({name} AS {kind})"
    failing = or_fail(value, name, f"served {name} ({kind})")
    return f"coalesce({failing}, raise_error('served {name} is null'))"


def as_served(gold: DataFrame, table: str, types: ServedTypes = ServedTypes()) -> DataFrame:
    """Gold rows in the served types. NULL, overflow and overlong text fail the job."""
    fields = {f.name: f for f in served_schema(table, types).fields[:-1]}
    keys, checks = zip(*[_served_key(fields[k], gold) for k in gold_table(table).keys])
    # The keys are checked along with the first value, which leaves them bare.
    first, *rest = [(f.name, _served_value(f)) for f in fields.values() if f.name not in gold_table(table).keys]
    checked = f"CASE WHEN {' AND '.join(checks)} THEN {first[1]} END AS {first[0]}"
    return gold.selectExpr(*keys, checked, *[f"{value} AS {name}" for name, value in rest])


def one_per_key(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``rows`` unchanged; a key that occurs twice fails the job.

    The check is a grouping on the merge keys, whose shuffle the merge join reuses.
    """
    rest = [c for c in rows.columns if c not in keys]
    grouped = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.expr(f"first({c}) AS {c}") for c in rest]
    )
    key = ", ', ', ".join(f"cast({k} AS string)" for k in keys)
    duplicate = f"raise_error(concat('duplicate key ', {key}))"
    checked = [f"CASE WHEN _copies = 1 THEN {c} ELSE {duplicate} END AS {c}" for c in rest]
    return grouped.selectExpr(*keys, *checked)


def merge(
    target: DataFrame, batch: DataFrame, table: str, loaded_at: datetime, types: ServedTypes = ServedTypes()
) -> DataFrame:
    """``target`` after inserting the rows of ``batch`` or updating them in place.

    One full outer join on the natural key. Target rows that the batch does not
    name stay; an updated row keeps the ``loaded_at`` of its first insert.
    """
    spec = gold_table(table)
    values = [c for c in spec.columns if c not in spec.keys]
    incoming = one_per_key(as_served(batch, table, types), spec.keys).selectExpr(
        *spec.keys, *[f"{c} AS new_{c}" for c in values]
    )
    # Served values are never NULL, so a NULL means that the row is missing on that side.
    return target.join(incoming, list(spec.keys), "full_outer").selectExpr(
        *spec.keys,
        *[f"coalesce(new_{c}, {c}) AS {c}" for c in values],
        f"coalesce(loaded_at, timestamp_ntz'{loaded_at.isoformat(sep=' ')}') AS loaded_at",
    )
