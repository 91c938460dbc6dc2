"""Latest bronze snapshots -> silver snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.errors import NothingToWrite, ReportLacksFields
from spendlake.operators.contract import contract_quarantine, contract_valid
from spendlake.operators.normalize import normalize, normalize_lenient
from spendlake.plans.isolate import Results, each
from spendlake.schemas import KNOWN_SOURCES
from spendlake.sources.landing import required_fields
from spendlake.sources.registry import source_spec
from spendlake.sources.snapshots import Written, latest_snapshot, read_snapshot, write_snapshot


def refine(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    at: datetime | None = None,
    quarantine_root: str | None = None,
    contract: bool = False,
    lenient: bool = False,
    cluster: bool = False,
) -> Results[Written]:
    """Normalize every platform's latest bronze snapshot; narrow, no shuffle, unless silver is to be clustered by date.

    The bronze schema comes from the snapshot's own footers, so raw columns the
    registry does not know are simply not read. A field that silver is made of and
    that occurs in no record fails the platform.

    A value that does not parse fails the platform too or, if ``lenient``, its row is
    set aside with the names of the columns. ``contract`` lets only rows through that
    fit the row contract. Rows set aside go below ``quarantine_root``, if there is one.
    """
    at = at or datetime.now()

    def normalize_latest(name: str) -> Written | None:
        path = latest_snapshot(spark, bronze_root, name)
        if path is None:
            return None
        raw, spec = read_snapshot(spark, path), source_spec(name)
        if lenient:
            rows = normalize_lenient(raw, spec, path, at)
            silver = rows.where("size(unparsed) = 0").drop("unparsed")
            refused = [("unparsed", rows.where("size(unparsed) > 0"))]
        else:
            silver, refused = normalize(raw, spec, path, at), []
        if contract:
            refused.append(("contract", contract_quarantine(silver)))
            silver = contract_valid(silver)
        _require(raw, spec.name, path, required_fields(raw, spec))
        for why, rows in refused if quarantine_root else []:
            _write_any(rows, f"{quarantine_root}/{why}", name, at)
        return write_snapshot(silver, silver_root, name, at, "date" if cluster else None)

    return each(spark, "refine", KNOWN_SOURCES, normalize_latest)


def _require(raw: DataFrame, platform: str, path: str, conditions: dict[str, str]) -> None:
    """Fail if a condition holds in no row; reads one narrow column."""
    if conditions:
        found = raw.agg(*[F.coalesce(F.bool_or(F.expr(c)), F.lit(True)).alias(f) for f, c in conditions.items()]).first()
        missing = [f for f in conditions if not found[f]]
        if missing:
            raise ReportLacksFields(platform, missing, path)


def _write_any(rows: DataFrame, root: str, name: str, at: datetime) -> None:
    """A snapshot of the rows, if there are any."""
    try:
        write_snapshot(rows, root, name, at)
    except NothingToWrite:
        return
