"""Latest bronze snapshots -> silver and quarantine in one pass, with the counters of the quality rules.

Bronze is read once and written once, in folders by verdict. The same pass notes which required fields occur at all, and
counts what the quality rules count. Only then folders are moved to where they belong, quarantine first and silver last,
so a run that dies leaves a hidden staging folder and nothing else. The counters are kept beside the snapshot, and the
quality run reads them instead of silver.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendlake.errors import NothingToWrite, ReportLacksFields
from spendlake.functions.casts import rounded
from spendlake.operators.contract import clean_source, fits_contract
from spendlake.operators.normalize import normalize, normalize_lenient
from spendlake.operators.quality import counted_by, report_of_counts
from spendlake.plans.check import check_file
from spendlake.plans.isolate import Results, each
from spendlake.schemas import KNOWN_SOURCES, SILVER_COLUMNS
from spendlake.sources.landing import required_fields
from spendlake.sources.registry import source_spec
from spendlake.sources.scratch import remove_path
from spendlake.sources.snapshots import Written, commit_snapshot, file_system, free_snapshot, get_text, latest_snapshot, put_text, read_snapshot

VALID, CONTRACT, UNPARSED = "valid", "contract", "unparsed"
COUNTERS_FILE = "_quality.json"


def judged(silver: DataFrame, contract: bool) -> DataFrame:
    """Silver rows with ``verdict``: valid, contract, or the columns that could not be read, joined by commas.

    Rows that the contract lets through are normalized as it says; all others stay as they are.
    """
    fits = fits_contract() if contract else "true"
    unread = "array_join(unparsed, ',')" if "unparsed" in silver.columns else "''"
    rows = silver.selectExpr(*SILVER_COLUMNS, f"{unread} AS _unread")
    rows = rows.selectExpr(
        *SILVER_COLUMNS, f"CASE WHEN _unread <> '' THEN _unread WHEN {fits} THEN '{VALID}' ELSE '{CONTRACT}' END AS verdict"
    )
    if not contract:
        return rows
    changed = {"source": clean_source(), "cost_brl": rounded("cost_brl", 6)}
    return rows.selectExpr(
        *[f"CASE WHEN verdict = '{VALID}' THEN {changed[c]} ELSE {c} END AS {c}" if c in changed else c for c in SILVER_COLUMNS], "verdict"
    )


def refine_once(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    at: datetime | None = None,
    quarantine_root: str | None = None,
    contract: bool = False,
    lenient: bool = False,
) -> Results[Written]:
    """As ``refine``, in one pass over each platform's bronze.

    Rows set aside by the contract go to ``{quarantine_root}/contract``, those that cannot be read to
    ``{quarantine_root}/unparsed`` with the names of the columns as the partition column ``unparsed``. The quarantine has
    to be on the file system of silver, as folders are moved. Without one, refused rows are left out.
    """
    at = at or datetime.now()
    if quarantine_root and file_system(spark, quarantine_root)[0].getUri().toString() != file_system(spark, silver_root)[0].getUri().toString():
        raise ValueError(f"{quarantine_root} is not on the file system of {silver_root}")

    def refine_one(name: str) -> Written | None:
        path = latest_snapshot(spark, bronze_root, name)
        if path is None:
            return None
        raw, spec = read_snapshot(spark, path), source_spec(name)
        fields, counts = Observation(), Observation()
        required = required_fields(raw, spec)
        if required:
            raw = raw.observe(fields, *[F.coalesce(F.bool_or(F.expr(c)), F.lit(True)).alias(f) for f, c in required.items()])
        rows = judged((normalize_lenient if lenient else normalize)(raw, spec, path, at), contract)
        refused = [f"count_if(verdict = '{CONTRACT}') AS _{CONTRACT}", f"count_if(verdict NOT IN ('{VALID}', '{CONTRACT}')) AS _{UNPARSED}"]
        rows = rows.observe(counts, *map(F.expr, [*counted_by(SILVER_COLUMNS, f"verdict = '{VALID}'"), *refused]))
        if not quarantine_root:
            rows = rows.where(f"verdict = '{VALID}'")
        staging = f"{silver_root.rstrip('/')}/{name}/.staging-{uuid.uuid4().hex}"
        try:
            write = rows.write.partitionBy("verdict").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            write.mode("error").parquet(staging)
            missing = [f for f in required if not fields.get[f]]
            if missing:
                raise ReportLacksFields(name, missing, path)
            counted = counts.get
            _move_refused(spark, staging, quarantine_root, name, at, {v: counted[f"_{v}"] for v in (CONTRACT, UNPARSED)})
            if not counted["_rows"]:
                raise NothingToWrite(f"nothing to write for {name!r}: no valid rows")
            target = free_snapshot(spark, silver_root, name, at)
            _move(spark, f"{staging}/verdict={VALID}", target)
            put_text(spark, f"{target}/{COUNTERS_FILE}", json.dumps(counted))
            commit_snapshot(spark, target, counted["_rows"])
            return Written(target, counted["_rows"])
        finally:
            remove_path(spark, staging)

    return each(spark, "refine", KNOWN_SOURCES, refine_one)


def _move(spark: SparkSession, source: str, target: str) -> None:
    (fs, old), (_, new) = file_system(spark, source), file_system(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"{source} cannot be moved to {target}")


def _move_refused(spark: SparkSession, staging: str, quarantine_root: str | None, name: str, at: datetime, rows: dict[str, int]) -> None:
    """Folders of other verdicts to the quarantine: one snapshot for the contract, one for what cannot be read."""
    fs, folder = file_system(spark, staging)
    found = [e.getPath().getName() for e in fs.listStatus(folder)] if fs.exists(folder) else []
    refused = [f.removeprefix("verdict=") for f in found if f.startswith("verdict=") and f != f"verdict={VALID}"]
    targets: dict[str, str] = {}
    for verdict in refused:
        why = CONTRACT if verdict == CONTRACT else UNPARSED
        target = targets.setdefault(why, free_snapshot(spark, f"{quarantine_root}/{why}", name, at) if why not in targets else "")
        _move(spark, f"{staging}/verdict={verdict}", target if why == CONTRACT else f"{target}/{UNPARSED}={verdict}")
    for why, target in targets.items():
        commit_snapshot(spark, target, rows[why])


def kept_report(spark: SparkSession, path: str) -> DataFrame:
    """The report of a silver snapshot from the counters kept beside it; from a scan, where there are none."""
    kept = get_text(spark, f"{path}/{COUNTERS_FILE}")
    if kept is None:
        return check_file(spark, path)
    counts = json.loads(kept)
    counted = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))
    return report_of_counts(counted.withColumn("source_file", F.lit(path)), SILVER_COLUMNS)


def check_kept(spark: SparkSession, silver_root: str) -> Results[DataFrame]:
    """As ``check``, without a scan of the snapshots that ``refine_once`` has written."""

    def report(name: str) -> DataFrame | None:
        path = latest_snapshot(spark, silver_root, name)
        return kept_report(spark, path) if path else None

    return each(spark, "check", KNOWN_SOURCES, report)
