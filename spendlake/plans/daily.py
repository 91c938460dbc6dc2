"""The whole run: bronze -> silver -> quality gate -> gold -> served."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import SparkSession

from spendlake.functions.dates import MAX_WINDOW_DAYS
from spendlake.operators.quality import gate, quality_summary
from spendlake.plans.check import check, reports_by_source
from spendlake.plans.ingest import ingest
from spendlake.plans.refine import refine
from spendlake.plans.runlog import append_run
from spendlake.plans.serve import serve_all
from spendlake.plans.summarize import summarize_all
from spendlake.schemas import ServedTypes
from spendlake.sources.snapshots import Written


@dataclass
class RunResult:
    stages: dict[str, Mapping[str, Written | int | None]] = field(default_factory=dict)
    failed_quality: list[str] = field(default_factory=list)


def run_daily(
    spark: SparkSession,
    landing_root: str,
    storage_root: str,
    window: tuple[date, date] | None = None,
    gate_mode: str = "fail",
    at: datetime | None = None,
    many_lines: bool = False,
    types: ServedTypes = ServedTypes(),
    max_days: int | None = MAX_WINDOW_DAYS,
    quarantine: bool = False,
    contract: bool = False,
) -> RunResult:
    """Run all stages in order; each finds its input on storage.

    A platform or table that fails does not stop the others. The run stops at a
    failed quality gate unless ``gate_mode`` is "warn", and when no gold table
    could be written or loaded. ``quarantine`` sets rows aside that cannot be read, and ``contract`` those that
    break the row contract, below ``{storage_root}/quarantine``.
    """
    at = at or datetime.now()
    roots = {layer: f"{storage_root.rstrip('/')}/{layer}" for layer in ("bronze", "silver", "gold", "served")}
    result = RunResult()

    def stage(name: str, work: Callable[[], Mapping[str, Written | int | None]]) -> None:
        started = time.monotonic()
        result.stages[name] = work()
        seconds = time.monotonic() - started
        append_run(spark, f"{storage_root.rstrip('/')}/run_log", name, result.stages[name], seconds, at)

    aside = f"{storage_root.rstrip('/')}/quarantine" if quarantine or contract else None
    stage("ingest", lambda: ingest(spark, landing_root, roots["bronze"], window, at, many_lines, max_days))
    stage("refine", lambda: refine(spark, roots["bronze"], roots["silver"], at, aside, contract, quarantine))

    reports = reports_by_source(check(spark, roots["silver"]))
    if reports is not None:
        result.failed_quality = gate(quality_summary(reports), gate_mode)

    stage("summarize", lambda: summarize_all(spark, roots["silver"], roots["gold"], at))
    _require_one(result, "summarize")
    stage("serve", lambda: serve_all(spark, roots["gold"], roots["served"], at, types))
    _require_one(result, "serve")
    return result


def _require_one(result: RunResult, stage: str) -> None:
    if all(r is None for r in result.stages[stage].values()):
        raise RuntimeError(f"stage {stage} produced nothing")
