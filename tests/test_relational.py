"""The statements only: there is no relational store to run them against here."""

from __future__ import annotations

import pytest

from spendlake.plans.relational import create_statement, merge_statement, staged_rows
from spendlake.schemas import GOLD_TABLES


def test_create_statement():
    assert create_statement("daily_summary") == (
        "CREATE TABLE IF NOT EXISTS gold_daily_summary (date DATE NOT NULL, source VARCHAR(50) NOT NULL, "
        "impressions BIGINT NOT NULL, clicks BIGINT NOT NULL, cost_brl NUMERIC(14, 6) NOT NULL, "
        "conversions BIGINT NOT NULL, ctr_pct NUMERIC(10, 4) NOT NULL, cpc_brl NUMERIC(10, 4) NOT NULL, "
        "cpm_brl NUMERIC(10, 4) NOT NULL, cpa_brl NUMERIC(10, 4) NOT NULL, "
        "loaded_at TIMESTAMP DEFAULT now(), CONSTRAINT pk_gold_daily_summary PRIMARY KEY (date, source))"
    )
    assert "campaign_name VARCHAR(255) NOT NULL" in create_statement("campaign_summary")


@pytest.mark.parametrize("table", GOLD_TABLES)
def test_merge_statement(table):
    text = merge_statement(table, "staging")
    assert f"ON CONFLICT ({', '.join(GOLD_TABLES[table].keys)}) DO UPDATE SET impressions = EXCLUDED." in text
    assert text.count("EXCLUDED.") == 8 and "loaded_at" not in text


def test_staged_rows_are_checked(spark, gold):
    assert staged_rows(gold("campaign_summary"), "campaign_summary").count() == 2
    with pytest.raises(Exception, match="duplicate key google_ads"):
        staged_rows(gold("source_comparison", source="google_ads"), "source_comparison").collect()


def test_unknown_table():
    with pytest.raises(KeyError):
        merge_statement("other", "staging")
