"""Command line: ``spark-submit ... -m spendlake <stage>`` or ``python -m spendlake <stage>``.

The exit code is 1 where the stage, or any part of it that counts, failed.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from spendlake.errors import QualityGateError
from spendlake.functions.dates import MAX_WINDOW_DAYS
from spendlake.operators.freshness import overall_status
from spendlake.operators.quality import gate, quality_failures, quality_summary
from spendlake.plans.check import check, reports_by_source
from spendlake.plans.daily import run_daily
from spendlake.plans.health import dataset_health, layer_health
from spendlake.plans.ingest import ingest
from spendlake.plans.refine import refine
from spendlake.plans.refine_once import check_kept, refine_once
from spendlake.plans.relational import serve_relational
from spendlake.plans.serve import serve_all
from spendlake.plans.serve_together import DEFAULT_BUCKETS, serve_together
from spendlake.plans.session import session
from spendlake.plans.summarize import summarize_all
from spendlake.plans.totals import summarize_restated
from spendlake.schemas import ServedTypes


def decimal(text: str) -> T.DecimalType:
    precision, scale = map(int, text.split(","))
    return T.DecimalType(precision, scale)


def parser() -> argparse.ArgumentParser:
    today = date.today()
    top = argparse.ArgumentParser(prog="spendlake", description=__doc__.splitlines()[0])
    stages = top.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, *paths: tuple[str, str]) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=text)
        for option, default in paths:
            sub.add_argument(f"--{option}-path", default=default, help=f"default: {default}")
        return sub

    landing, bronze = ("landing", "storage/landing"), ("bronze", "storage/bronze")
    silver, gold = ("silver", "storage/silver"), ("gold", "storage/gold")
    served, storage = ("served", "storage/served"), ("storage", "storage")

    for sub in (
        stage("ingest", "landed JSON reports -> bronze", landing, bronze),
        stage("daily", "the whole run", landing, storage),
    ):
        sub.add_argument("--start-date", type=date.fromisoformat, default=today - timedelta(days=7))
        sub.add_argument("--end-date", type=date.fromisoformat, default=today)
        sub.add_argument("--many-lines", action="store_true", help="a file holds one JSON report, over any number of lines")
        sub.add_argument("--max-days", type=int, default=MAX_WINDOW_DAYS, help="longest window; 0 for any")
    sub.add_argument("--gate", choices=("fail", "warn"), default="fail", help="what a failed quality rule does")
    daily = sub
    refining = stage("refine", "bronze -> silver", bronze, silver)
    refining.add_argument("--cluster", action="store_true", help="silver in ranges of dates, for scans of date windows; not with --once")
    refining.add_argument("--once", action="store_true", help="read bronze once, and count for the quality rules on the way")
    refining.add_argument("--quarantine-path", default="storage/quarantine", help="where refused rows go")
    for sub in (daily, refining):
        sub.add_argument("--on-error", choices=("fail", "quarantine"), default="fail", help="for values that cannot be read")
        sub.add_argument("--contract", action="store_true", help="set rows aside that break the row contract")
    checking = stage("check", "quality rules on silver", silver)
    checking.add_argument("--kept", action="store_true", help="from the counters that refine --once keeps; scans only what has none")
    summing = stage("summarize", "silver -> gold", silver, gold)
    summing.add_argument("--totals-path", help="keep totals there and sum only the days that silver has rows of")
    serving = stage("serve", "gold -> served tables", gold, served)
    serving.add_argument("--jdbc-url", help="load a relational store instead of served snapshots")
    serving.add_argument("--together", action="store_true", help="served tables in buckets, all loaded in one commit")
    serving.add_argument("--buckets", type=int, default=DEFAULT_BUCKETS, help="buckets of a table that is new to --together")
    for sub in (daily, serving):
        sub.add_argument("--money", type=decimal, default=ServedTypes().money, help="precision,scale of costs")
        sub.add_argument("--ratio", type=decimal, default=ServedTypes().ratio, help="precision,scale of ratios")
    stage("health", "freshness of the layers", storage)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one stage; returns the exit code."""
    if args.stage == "ingest":
        window = (args.start_date, args.end_date)
        ingest(spark, args.landing_path, args.bronze_path, window, None, args.many_lines, args.max_days or None)
        return 0
    if args.stage == "refine":
        lenient = args.on_error == "quarantine"
        common = spark, args.bronze_path, args.silver_path, None, args.quarantine_path, args.contract, lenient
        refine_once(*common) if args.once else refine(*common, cluster=args.cluster)
        return 0
    if args.stage == "check":
        reports = reports_by_source((check_kept if args.kept else check)(spark, args.silver_path))
        if reports is None:
            return 0
        quality_failures(reports).show(truncate=False)
        return 1 if gate(quality_summary(reports), "warn") else 0
    if args.stage == "summarize":
        if args.totals_path:
            return int(None in summarize_restated(spark, args.silver_path, args.totals_path, args.gold_path).values())
        return int(None in summarize_all(spark, args.silver_path, args.gold_path).values())
    if args.stage == "serve":
        types = ServedTypes(args.money, args.ratio)
        if args.jdbc_url:
            return int(None in serve_relational(spark, args.gold_path, args.jdbc_url, types=types).values())
        if args.together:
            return int(not serve_together(spark, args.gold_path, args.served_path, types=types, buckets=args.buckets))
        return int(None in serve_all(spark, args.gold_path, args.served_path, types=types).values())
    if args.stage == "health":
        layers = layer_health(spark, args.storage_path)
        layers.show(truncate=False)
        datasets = dataset_health(spark, args.storage_path)
        if datasets is not None:
            datasets.show(truncate=False)
        return int(overall_status(layers).first().status != "healthy")
    try:
        window = (args.start_date, args.end_date)
        run_daily(
            spark,
            args.landing_path,
            args.storage_path,
            window,
            args.gate,
            many_lines=args.many_lines,
            types=ServedTypes(args.money, args.ratio),
            max_days=args.max_days or None,
            quarantine=args.on_error == "quarantine",
            contract=args.contract,
        )
    except (QualityGateError, RuntimeError) as error:
        logging.getLogger("spendlake").error("%s", error)
        return 1
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s | %(levelname)s | %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    args = parser().parse_args(argv)
    return run(session(), args)


if __name__ == "__main__":
    sys.exit(main())
