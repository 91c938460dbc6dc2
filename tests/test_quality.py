from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlake.errors import QualityGateError
from spendlake.operators import contract, quality
from spendlake.plans.check import check, check_file, reports_by_source
from spendlake.sources.snapshots import write_snapshot

GOOD = [
    (date(2026, 3, 1), "google_ads", "Garden", "Spades", 6000, 300, 750.0, 30),
    (date(2026, 3, 2), "google_ads", "Balcony", "Pots", 4000, 80, 160.5, 8),
]


def failed(df):
    return {(r.expectation_type, r.column): r for r in quality.quality_report(df, "f").collect() if not r.success}


def test_18_rules_pass_on_good_rows(silver):
    rows = quality.quality_report(silver(GOOD), "f").collect()
    assert [r.rule for r in rows] == list(range(1, 19))
    assert all(r.success for r in rows)
    summary = quality.quality_summary(quality.quality_report(silver(GOOD), "f")).first()
    assert (summary.success, summary.total_expectations, summary.passed, summary.failed) == (True, 18, 18, 0)


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"source": "unknown_platform"}, (quality.IN_SET, "source")),
        ({"date": None}, (quality.NOT_NULL, "date")),
        ({"campaign_name": None}, (quality.NOT_NULL, "campaign_name")),
        ({"impressions": 100, "clicks": 999, "conversions": 1}, (quality.PAIR_ORDER, "impressions")),
        ({"clicks": 100, "conversions": 999}, (quality.PAIR_ORDER, "clicks")),
        ({"cost_brl": -1.0}, (quality.BETWEEN, "cost_brl")),
        ({"conversions": -1}, (quality.BETWEEN, "conversions")),
        ({"cost_brl": float("nan")}, (quality.NOT_NULL, "cost_brl")),
    ],
)
def test_one_violation_per_case(silver, change, rule):
    bad = failed(silver(GOOD, **change))
    assert list(bad) == [rule]
    assert (bad[rule].unexpected_count, bad[rule].unexpected_percent) == (2, 100.0)


def test_pairs_with_nulls(silver):
    half = failed(silver(GOOD, clicks=None))
    assert half[(quality.PAIR_ORDER, "impressions")].unexpected_count == 2
    both = failed(silver(GOOD, clicks=None, conversions=None))
    assert (quality.PAIR_ORDER, "clicks") not in both


def test_percent_is_of_the_rows_a_rule_looks_at(silver):
    rows = silver(GOOD).withColumn("source", F.expr("CASE WHEN date = DATE'2026-03-01' THEN 'x' END"))
    bad = failed(rows)
    assert bad[(quality.IN_SET, "source")].unexpected_percent == 100.0
    assert bad[(quality.NOT_NULL, "source")].unexpected_percent == 50.0


def test_missing_columns_fail_without_counts(silver):
    bad = failed(silver(GOOD).drop("clicks"))
    assert set(bad) == {
        (quality.COLUMNS_PRESENT, None),
        (quality.NOT_NULL, "clicks"),
        (quality.BETWEEN, "clicks"),
        (quality.PAIR_ORDER, "impressions"),
        (quality.PAIR_ORDER, "clicks"),
    }
    assert {r.unexpected_count for r in bad.values()} == {None}
    assert not failed(silver(GOOD).withColumn("extra", F.lit(1)))


def test_empty_silver_passes(silver):
    rows = quality.quality_report(silver([]), "f").collect()
    assert len(rows) == 18 and all(r.success for r in rows)


def test_one_scan_and_one_shuffle(spark, silver, root):
    silver(GOOD).write.parquet(f"{root}/s")
    report = quality.quality_report(spark.read.parquet(f"{root}/s"), F.col("source"))
    text = report._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_check_of_a_root(spark, silver, root):
    write_snapshot(silver(GOOD), root, "google_ads")
    write_snapshot(silver(GOOD, source="meta_ads", cost_brl=-1.0), root, "meta_ads")
    reports = check(spark, root)
    assert reports["tiktok_ads"] is None
    summary = quality.quality_summary(reports_by_source(reports))
    verdict = {r.source_file: (r.success, r.failed) for r in quality.with_missing_sources(summary).collect()}
    assert verdict == {"google_ads": (True, 0), "meta_ads": (False, 1), "tiktok_ads": (None, None)}
    with pytest.raises(QualityGateError, match="meta_ads"):
        quality.gate(summary)
    assert quality.gate(summary, mode="warn") == ["meta_ads"]
    failures = quality.quality_failures(reports["meta_ads"]).collect()
    assert [(f.expectation_type, f.column, f.unexpected_count) for f in failures] == [
        (quality.BETWEEN, "cost_brl", 2)
    ]


def test_gate_mode_is_checked(silver):
    with pytest.raises(ValueError):
        quality.gate(quality.quality_summary(quality.quality_report(silver(GOOD), "f")), mode="maybe")


def test_nothing_to_report(spark, root):
    assert reports_by_source(check(spark, root)) is None


@pytest.mark.parametrize("damage", ["missing", "garbage"])
def test_unreadable_file_is_a_failed_report(spark, tmp_path, damage):
    path = tmp_path / "google_ads_20260312_100000.parquet"
    if damage == "garbage":
        path.write_bytes(b"PAR1 this is not parquet PAR1")
    report = check_file(spark, str(path))
    row = report.first()
    assert (row.expectation_type, row.success, row.unexpected_count) == (quality.READ_ERROR, False, None)
    summary = quality.quality_summary(report).first()
    assert (summary.success, summary.total_expectations, summary.passed, summary.failed) == (False, 0, 0, 1)


@pytest.mark.parametrize(
    "change",
    [
        {"date": None}, {"source": "other"}, {"source": None}, {"campaign_name": ""}, {"ad_group_name": None},
        {"impressions": -1}, {"clicks": None}, {"cost_brl": -0.01}, {"cost_brl": float("nan")},
        {"conversions": -1}, {"source_file": ""}, {"transformed_at": None},
    ],
)
def test_contract_quarantines(silver, change):
    rows = silver(GOOD, **change)
    assert contract.contract_valid(rows).count() == 0
    assert contract.contract_quarantine(rows).count() == 2


@pytest.mark.parametrize("source", ["Google_Ads", " google_ads\t", " GOOGLE_ADS　", "\x1cgoogle_ads\n"])
def test_contract_normalizes(silver, source):
    row = contract.contract_valid(silver(GOOD, source=source, cost_brl=1.23456789)).first()
    assert (row.source, row.cost_brl) == ("google_ads", 1.234568)
