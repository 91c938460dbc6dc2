from __future__ import annotations

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlake.functions.cost import COST_PARTS
from spendlake.operators import aggregate
from spendlake.schemas import GOLD_TABLES

BUILDERS = {
    "daily_summary": aggregate.daily_summary,
    "campaign_summary": aggregate.campaign_summary,
    "source_comparison": aggregate.source_comparison,
}


@pytest.mark.parametrize("table, rows", [("daily_summary", 4), ("campaign_summary", 4), ("source_comparison", 2)])
def test_rows_and_columns(silver, table, rows):
    gold = BUILDERS[table](silver())
    assert tuple(gold.columns) == GOLD_TABLES[table].columns
    assert gold.count() == rows


def test_daily_values_and_order(silver):
    rows = aggregate.daily_summary(silver()).collect()
    assert [(r.date.day, r.source) for r in rows] == [
        (1, "google_ads"), (1, "meta_ads"), (2, "google_ads"), (2, "meta_ads"),
    ]
    first = rows[0]
    assert (first.impressions, first.clicks, first.cost_brl, first.conversions) == (8000, 360, 870.0, 36)
    assert (first.ctr_pct, first.cpc_brl, first.cpm_brl, first.cpa_brl) == (4.5, 2.4167, 108.75, 24.1667)


def test_campaign_values_and_order(silver):
    rows = aggregate.campaign_summary(silver()).collect()
    assert [(r.source, r.campaign_name) for r in rows] == [
        ("google_ads", "Balcony"), ("google_ads", "Garden"), ("meta_ads", "Garden"), ("meta_ads", "Shoes"),
    ]
    assert rows[1].impressions == 11000


def test_source_values_and_order(silver):
    rows = aggregate.source_comparison(silver()).collect()
    assert [(r.source, r.cost_brl) for r in rows] == [("google_ads", 1370.0), ("meta_ads", 375.0)]


@pytest.mark.parametrize(
    "change, zero",
    [
        ({"impressions": 0}, ("ctr_pct", "cpm_brl")),
        ({"clicks": 0}, ("cpc_brl",)),
        ({"conversions": 0}, ("cpa_brl",)),
        ({"impressions": -5}, ("ctr_pct", "cpm_brl")),
    ],
)
def test_no_positive_denominator_gives_zero(silver, change, zero):
    row = aggregate.source_comparison(silver(**change)).first()
    assert all(row[c] == 0.0 for c in zero)


def test_null_metrics_and_keys(silver):
    row = aggregate.source_comparison(silver(impressions=None, cost_brl=None)).first()
    assert (row.impressions, row.cost_brl, row.ctr_pct) == (0, 0.0, 0.0)
    assert aggregate.daily_summary(silver(date=None)).count() == 2
    assert aggregate.distinct_sources(silver(source=None)).first().sources == 1
    assert aggregate.distinct_sources(silver()).first().sources == 2


def test_missing_columns(silver):
    with pytest.raises(ValueError, match="campaign_name"):
        aggregate.campaign_summary(silver().drop("campaign_name"))
    with pytest.raises(ValueError, match="clicks"):
        aggregate.daily_summary(silver().drop("clicks"))


def many(costs):
    return [(date(2026, 3, 1), "google_ads", f"C{i % 7}", "G", 10, 5, c, 1) for i, c in enumerate(costs)]


def test_cost_sum_is_exact_in_any_order(silver):
    rng = random.Random(7)
    costs = [round(rng.uniform(-50, 100000), rng.choice([0, 2, 4, 6])) for _ in range(5000)]
    costs += [4e-7] * 3 + [1e15 + 0.125, -3e-9, 1e-17, 2.5e17]
    exact = math.fsum(costs)
    for parts in (1, 3, 8):
        rng.shuffle(costs)
        total = aggregate.source_comparison(silver(many(costs)).repartition(parts)).first().cost_brl
        assert total == exact


def test_cost_beyond_exact_range(silver):
    assert aggregate.source_comparison(silver(many([1.5, 4e15]))).first().cost_brl == math.fsum([1.5, 4e15])
    assert aggregate.source_comparison(silver(many([1.5, float("inf")]))).first().cost_brl == float("inf")
    nan = aggregate.source_comparison(silver(many([1.5, float("nan")]))).first().cost_brl
    assert nan != nan
    assert aggregate.source_comparison(silver(many([0.1234567, 1.0]))).first().cost_brl == 1.1234567


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cost_of_very_many_rows(spark, silver, ansi):
    """Small parts reach the total, large totals do not wrap, and what does not fit fails."""
    one = silver().limit(1).drop("cost_brl").crossJoin(spark.range(1_000_000)).drop("id")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        total = lambda cost, n: aggregate.source_comparison(one.limit(n).withColumn("cost_brl", F.lit(cost))).first().cost_brl
        assert total(4e-7, 1_000_000) == math.fsum([4e-7] * 1_000_000)
        assert total(9e14, 20_000) == 1.8e19
        with pytest.raises(Exception, match="out of range"):
            total(9e29, 20_000)
        with pytest.raises(Exception, match="out of range"):
            total(1e30, 1)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("table", GOLD_TABLES)
def test_rolling_up_equals_summing_directly(silver, table):
    rng = random.Random(3)
    rows = silver(many([round(rng.uniform(0, 999), 2) for _ in range(500)]) + many([None, float("nan")]))
    grain = aggregate.shared_grain(GOLD_TABLES)
    assert grain == ["date", "source", "campaign_name"]
    shared = aggregate.sum_parts(aggregate.metric_parts(rows, grain), grain)
    assert set(COST_PARTS) <= set(shared.columns)
    rolled = aggregate.finish(aggregate.sum_parts(shared, GOLD_TABLES[table].keys), table)
    direct = aggregate.summarize(rows, table)
    assert sorted(map(repr, rolled.collect())) == sorted(map(repr, direct.collect()))


def test_plan_reads_only_what_it_needs(spark, silver, root):
    silver().write.parquet(f"{root}/s")
    plan = aggregate.summarize(spark.read.parquet(f"{root}/s"), "source_comparison")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "campaign_name" not in text and "transformed_at" not in text
    assert text.count("Exchange") == 1
