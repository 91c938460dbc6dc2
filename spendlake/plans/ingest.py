"""Landed JSON reports -> bronze snapshots."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import SparkSession

from spendlake.functions.dates import MAX_WINDOW_DAYS, check_window, date_window
from spendlake.plans.isolate import Results, each
from spendlake.schemas import KNOWN_SOURCES
from spendlake.sources.documents import report_records
from spendlake.sources.landing import parse_records, read_envelopes, unnest_envelope, with_ingest_columns
from spendlake.sources.registry import source_spec
from spendlake.sources.snapshots import Written, latest_snapshot, write_snapshot


def ingest(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    window: tuple[date, date] | None = None,
    at: datetime | None = None,
    many_lines: bool = False,
    max_days: int | None = MAX_WINDOW_DAYS,
) -> Results[Written]:
    """Write the records of every platform's newest finished landing run as a bronze snapshot.

    Reports come one per line or, with ``many_lines``, one per file, of any length.

    ``window`` keeps the days in it, both ends included; it spans ``max_days`` at most, any number if None. A platform
    without a run or records, or whose reports cannot be read, yields None.
    """
    if window is not None:
        check_window(*window, max_days)
    at = at or datetime.now()

    def land(name: str) -> Written | None:
        spec = source_spec(name)
        run = latest_snapshot(spark, landing_root, name, kind="landed")
        if run is None:
            return None
        if many_lines:
            rows = parse_records(report_records(spark, spec, run), spec)
        else:
            rows = unnest_envelope(read_envelopes(spark, spec, run), spec)
        if window is not None:
            rows = date_window(rows, *window, day=spec.parse_date(spec.columns["date"]), max_days=max_days)
        return write_snapshot(with_ingest_columns(rows, spec, at.date()), bronze_root, name, at)

    return each(spark, "ingest", KNOWN_SOURCES, land)
