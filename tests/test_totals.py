"""Totals that follow restated days, against sums of all rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from test_cli import call

from spendlake.errors import StaleWriter
from spendlake.operators.aggregate import finish, metric_parts, sum_parts
from spendlake.plans import totals as plan
from spendlake.plans.totals import gold_from, restate, summarize_restated, totals
from spendlake.schemas import GOLD_TABLES
from spendlake.sources.buckets import read_manifest
from spendlake.sources.snapshots import write_snapshot

AT, LATER = datetime(2026, 3, 12, 10), datetime(2026, 3, 13, 10)
DAYS = [date(2026, 1, 1) + timedelta(days=i) for i in range(30)]


def some_rows(seed: int, days=DAYS, n=600):
    rng = random.Random(seed)
    sources = ("google_ads", "meta_ads")
    return [
        (rng.choice(days), rng.choice(sources), f"c{rng.randint(0, 5)}", "g", rng.randint(0, 99), rng.randint(0, 9), rng.lognormvariate(0, 9) / 7, 1)
        for _ in range(n)
    ]


def whole(silver):
    """Gold summed from all rows at once, by table."""
    return {t: sorted(finish(sum_parts(metric_parts(silver, g.keys), g.keys), t).collect(), key=repr) for t, g in GOLD_TABLES.items()}


def kept(spark, root):
    return {t: sorted(gold.collect(), key=repr) for t, gold in gold_from(totals(spark, root)).items()}


def test_a_restated_day_gives_the_same_bits(spark, silver, root):
    first, second = some_rows(1), some_rows(2, DAYS[10:12], 50)
    restate(spark, silver(first), root, AT)
    assert kept(spark, root) == whole(silver(first))
    replaced = {(r[0], r[1]) for r in second}
    restate(spark, silver(second), root, LATER)
    assert kept(spark, root) == whole(silver([r for r in first if (r[0], r[1]) not in replaced] + second))


def test_days_in_any_order_and_twice(spark, silver, root):
    rows = some_rows(3, DAYS[:6], 200)
    days = DAYS[:6] + DAYS[2:4]
    random.Random(0).shuffle(days)
    for day in days:
        restate(spark, silver([r for r in rows if r[0] == day]), root, AT, buckets=4)
    assert kept(spark, root) == whole(silver(rows))


def test_only_buckets_of_changed_days_are_written(spark, silver, root):
    restate(spark, silver(some_rows(4)), root, AT)
    files = {p: p.stat().st_mtime_ns for p in Path(root).rglob("part-*")}
    before = read_manifest(spark, root).tables["totals"].loads
    after = restate(spark, silver(some_rows(5, DAYS[:1], 9)), root, LATER).tables["totals"].loads
    assert sum(before[b] != after[b] for b in before) == 1
    assert {p: p.stat().st_mtime_ns for p in files} == files


def test_a_window_replaces_days_without_rows(spark, silver, root):
    rows = some_rows(6)
    restate(spark, silver(rows), root, AT)
    new = [(DAYS[4], "google_ads", "c1", "g", 5, 1, 2.5, 0)]
    restate(spark, silver(new), root, LATER, (DAYS[3], DAYS[20]))
    left = [r for r in rows if not (r[1] == "google_ads" and DAYS[3] <= r[0] <= DAYS[20])]
    assert kept(spark, root) == whole(silver(left + new))
    with pytest.raises(ValueError, match="outside the window"):
        restate(spark, silver(some_rows(7)), root, LATER, (DAYS[3], DAYS[20]))
    assert kept(spark, root) == whole(silver(left + new))


def test_a_bucket_that_loses_its_last_day(spark, silver, root):
    restate(spark, silver(some_rows(8, DAYS[:3])), root, AT)
    rows = [(DAYS[9], s, "c1", "g", 5, 1, 2.5, 0) for s in ("google_ads", "meta_ads")]
    restate(spark, silver(rows), root, LATER, (DAYS[0], DAYS[9]))
    assert kept(spark, root) == whole(silver(rows))


def test_null_keys_and_loose_costs(spark, silver, root):
    rows = [(None, "google_ads", "c", "g", 1, 1, float("nan"), 1), (DAYS[0], None, None, "g", 1, 1, float("inf"), 1), (DAYS[0], "meta_ads", "c", "g", None, 0, None, 2)]
    for at in (AT, LATER):
        restate(spark, silver(rows), root, at)
        assert repr(kept(spark, root)) == repr(whole(silver(rows)))


def test_the_slower_of_two_writers_fails(spark, silver, root, monkeypatch):
    restate(spark, silver(some_rows(1)), root, AT)
    write = plan.write_buckets

    def slow(*args):
        monkeypatch.setattr(plan, "write_buckets", write)
        restate(spark, silver(some_rows(2)), root, LATER)
        return write(*args)

    monkeypatch.setattr(plan, "write_buckets", slow)
    with pytest.raises(StaleWriter):
        restate(spark, silver(some_rows(3)), root, LATER)
    assert read_manifest(spark, root).version == 2


def test_gold_from_snapshots(spark, silver, root):
    paths = {k: f"{root}/{k}" for k in ("silver", "totals", "gold")}
    assert set(summarize_restated(spark, *paths.values(), AT).values()) == {None}
    google = [r for r in some_rows(9) if r[1] == "google_ads"]
    write_snapshot(silver(google), paths["silver"], "google_ads", AT)
    args = ("--silver-path", paths["silver"], "--totals-path", paths["totals"], "--gold-path", paths["gold"])
    assert call(spark, "summarize", *args) == 0
    assert restate(spark, silver([]), paths["totals"]).version == 1
    assert spark.read.parquet(f"{paths['gold']}/source_comparison").drop("snapshot").collect() == whole(silver(google))["source_comparison"]
