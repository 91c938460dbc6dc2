"""One pass over bronze gives what several gave before."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql.readwriter import DataFrameWriter
from test_cli import call

from spendlake.operators.quality import quality_report
from spendlake.plans import refine_once as once
from spendlake.plans.refine import refine
from spendlake.plans.refine_once import check_kept, kept_report, refine_once
from spendlake.schemas import SILVER_SCHEMA
from spendlake.sources.landing import RECORD_COLUMNS
from spendlake.sources.snapshots import latest_snapshot, read_snapshot, write_snapshot

AT, LATER = datetime(2026, 3, 12, 10), datetime(2026, 3, 13, 10)
TIKTOK = "tiktok_ads"


@pytest.fixture
def bronze(spark, raw, root):
    """A bronze snapshot of valid, unreadable and forbidden rows."""
    good = raw(TIKTOK)
    rows = good.union(raw(TIKTOK, total_cost="n/a")).union(raw(TIKTOK, total_cost="n/a", stat_time="x")).union(raw(TIKTOK, views=-1))
    write_snapshot(rows.union(good).coalesce(2), f"{root}/bronze", TIKTOK, AT)
    return f"{root}/bronze"


def all_rows(spark, root, name=TIKTOK):
    path = latest_snapshot(spark, root, name)
    return None if path is None else sorted(map(repr, read_snapshot(spark, path).collect()))


@pytest.mark.parametrize("contract", [False, True])
def test_same_rows_as_in_several_passes(spark, bronze, root, contract):
    args = dict(contract=contract, lenient=True)
    many = refine(spark, bronze, f"{root}/a", AT, f"{root}/aside-a", **args)
    one = refine_once(spark, bronze, f"{root}/b", AT, f"{root}/aside-b", **args)
    assert one[TIKTOK].rows == many[TIKTOK].rows
    assert all_rows(spark, f"{root}/b") == all_rows(spark, f"{root}/a")
    assert read_snapshot(spark, one[TIKTOK].path).schema == read_snapshot(spark, many[TIKTOK].path).schema
    assert all_rows(spark, f"{root}/aside-b/contract") == all_rows(spark, f"{root}/aside-a/contract")
    unread = read_snapshot(spark, latest_snapshot(spark, f"{root}/aside-b/unparsed", TIKTOK))
    assert sorted(r.unparsed for r in unread.collect()) == ["cost_brl"] * 2 + ["date,cost_brl"] * 2
    before = read_snapshot(spark, latest_snapshot(spark, f"{root}/aside-a/unparsed", TIKTOK))
    assert sorted(map(repr, unread.drop("unparsed").collect())) == sorted(map(repr, before.drop("unparsed").collect()))
    assert not list(Path(root).rglob(".staging*"))


def test_bronze_is_scanned_once_and_silver_never(spark, bronze, root, monkeypatch):
    plans, actions = [], []
    write = DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    for name in ("collect", "first", "count", "isEmpty", "take"):
        monkeypatch.setattr(DataFrame, name, lambda self, *a, n=name: actions.append(n))
    assert refine_once(spark, bronze, f"{root}/b", AT, f"{root}/aside", True, True)[TIKTOK].rows == 4
    assert len(plans) == 1 and plans[0].count("FileScan parquet") == 1 and "Exchange" not in plans[0]
    reports = check_kept(spark, f"{root}/b")
    assert "FileScan" not in reports[TIKTOK]._jdf.queryExecution().executedPlan().toString()
    assert not actions


def test_kept_counters_give_the_report_of_a_scan(spark, bronze, root):
    path = refine_once(spark, bronze, f"{root}/b", AT, lenient=True)[TIKTOK].path
    report = quality_report(spark.read.schema(SILVER_SCHEMA).parquet(path), path)
    assert kept_report(spark, path).collect() == report.collect()
    assert not all(r.success for r in report.collect())
    (Path(path.removeprefix("file:")) / once.COUNTERS_FILE).unlink()
    assert kept_report(spark, path).collect() == report.collect()


def test_strict_values_fail_and_leave_nothing(spark, bronze, root):
    done = refine_once(spark, bronze, f"{root}/b", AT, f"{root}/aside")
    assert "tiktok_ads" in done.errors[TIKTOK]
    assert latest_snapshot(spark, f"{root}/b", TIKTOK) is None
    assert not list(Path(root, "b").rglob("*.parquet")) and not Path(root, "aside").exists()


def test_without_quarantine_refused_rows_are_left_out(spark, bronze, root):
    assert refine_once(spark, bronze, f"{root}/b", AT, None, True, True)[TIKTOK].rows == 4
    assert len(all_rows(spark, f"{root}/b")) == 4


def test_fields_that_occur_in_no_record(spark, raw, root):
    rows = raw(TIKTOK).selectExpr("*", "'{}' AS _record", "array('views', 'stat_time') AS _fields")
    assert set(RECORD_COLUMNS) <= set(rows.columns)
    write_snapshot(rows, f"{root}/bronze", TIKTOK, AT)
    error = refine_once(spark, f"{root}/bronze", f"{root}/b", AT).errors[TIKTOK]
    assert error == refine(spark, f"{root}/bronze", f"{root}/c", AT).errors[TIKTOK]
    assert "total_cost" in error and not list(Path(root, "b").rglob("*.parquet"))


def test_only_refused_rows(spark, raw, root):
    write_snapshot(raw(TIKTOK, views=-1), f"{root}/bronze", TIKTOK, AT)
    done = refine_once(spark, f"{root}/bronze", f"{root}/b", AT, f"{root}/aside", contract=True)
    assert done[TIKTOK] is None and "no valid rows" in done.skipped[TIKTOK]
    assert len(all_rows(spark, f"{root}/aside/contract")) == 2


def test_a_second_run_of_the_same_second(spark, bronze, root):
    paths = [refine_once(spark, bronze, f"{root}/b", AT, f"{root}/aside", True, True)[TIKTOK].path for _ in range(2)]
    assert paths[0] < paths[1]
    assert len(list(Path(root, "aside", "unparsed", TIKTOK).glob("snapshot=*"))) == 2


def test_from_the_command_line(spark, bronze, root):
    paths = ("--silver-path", f"{root}/silver")
    assert call(spark, "refine", "--once", "--on-error", "quarantine", "--bronze-path", bronze, "--quarantine-path", f"{root}/q", *paths) == 0
    assert call(spark, "check", "--kept", *paths) == call(spark, "check", *paths) == 1
