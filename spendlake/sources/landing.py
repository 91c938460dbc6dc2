"""Landed JSON reports -> raw rows.

One landing run is one folder, ``{landing}/{source}/landed=YYYYMMDD_HHMMSS/``, finished by an empty file ``_SUCCESS``.
A report that restates days of an earlier one replaces it as a whole, so only the newest finished run is read.
Reports come one per line, and a file is split among tasks, or one per file, which ``sources.documents`` splits.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.sources.registry import SourceSpec

# What a raw row has beside the fields that are known: the record as it came, and the names of its fields.
RECORD_COLUMNS = ("_record", "_fields")


def read_envelopes(spark: SparkSession, spec: SourceSpec, path: str, many_lines: bool = False) -> DataFrame:
    """Reports landed as JSON, one envelope per line or, with ``many_lines``, per file; then each is one row.

    Records are kept as the text they came in. What is no report fails the read: a value that turned NULL silently
    would pass for missing data.
    """
    reader = spark.read.schema(spec.envelope_schema()).option("mode", "FAILFAST").option("recursiveFileLookup", True)
    return reader.json(path, multiLine=many_lines)


def unnest_envelope(envelopes: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row per record of the envelope's array; no record where the array is missing.

    A field that does not fit its type fails the job; counts may be fractional. ``_record`` has the fields that are not
    known too, and ``_fields`` tells a field that is missing from one that is null.

    The outer form keeps Spark from adding a filter on the array's size, which
    would parse JSON text that is read with ``from_json`` a second time.
    """
    records = envelopes.selectExpr(f"explode_outer(`{spec.envelope_key}`) AS _record").where("_record IS NOT NULL")
    return parse_records(records, spec)


def parse_records(records: DataFrame, spec: SourceSpec) -> DataFrame:
    """The raw columns of records kept as text, ``_record``, beside what ``RECORD_COLUMNS`` names."""
    parsed = F.from_json("_record", spec.landed_schema, {"mode": "FAILFAST"})
    return records.select(parsed.alias("r"), "_record", F.expr("json_object_keys(_record) AS _fields")).select("r.*", *RECORD_COLUMNS)


def with_ingest_columns(raw: DataFrame, spec: SourceSpec, ingested_on: date) -> DataFrame:
    """Add ``_source`` and the ISO day of ingestion."""
    return raw.withColumns(
        {"_source": F.lit(spec.name), "_ingested_at": F.lit(ingested_on.isoformat())}
    )


def required_fields(raw: DataFrame, spec: SourceSpec) -> dict[str, str]:
    """Conditions of which each has to hold in some row, by field: the platform's report has it at all."""
    if "_fields" not in raw.columns:
        return {}
    return {f: f"array_contains(_fields, '{f}')" for f in spec.required}
