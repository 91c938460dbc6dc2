from __future__ import annotations

import pytest
from test_storage import land

from spendlake.__main__ import parser, run
from spendlake.plans.serve import served
from spendlake.schemas import KNOWN_SOURCES

WINDOW = ["--start-date", "2026-03-01", "--end-date", "2026-03-02"]


def call(spark, *args):
    return run(spark, parser().parse_args([str(a) for a in args]))


def test_stages_one_by_one(spark, root):
    for name in KNOWN_SOURCES:
        landing = land(root, name)
    paths = {layer: f"{root}/store/{layer}" for layer in ("bronze", "silver", "gold", "served")}
    assert call(spark, "ingest", "--landing-path", landing, "--bronze-path", paths["bronze"], *WINDOW) == 0
    assert call(spark, "refine", "--bronze-path", paths["bronze"], "--silver-path", paths["silver"]) == 0
    assert call(spark, "check", "--silver-path", paths["silver"]) == 0
    assert call(spark, "health", "--storage-path", f"{root}/store") == 1  # gold is missing
    assert call(spark, "summarize", "--silver-path", paths["silver"], "--gold-path", paths["gold"]) == 0
    assert call(spark, "serve", "--gold-path", paths["gold"], "--served-path", paths["served"]) == 0
    assert call(spark, "health", "--storage-path", f"{root}/store") == 0
    assert served(spark, paths["served"], "daily_summary").count() == 6


def test_failures_set_the_exit_code(spark, root):
    assert call(spark, "summarize", "--silver-path", f"{root}/a", "--gold-path", f"{root}/b") == 1
    assert call(spark, "serve", "--gold-path", f"{root}/b", "--served-path", f"{root}/c") == 1
    assert call(spark, "check", "--silver-path", f"{root}/a") == 0  # nothing to check is tolerated


@pytest.mark.parametrize("mode, code", [("fail", 1), ("warn", 0)])
def test_daily(spark, root, mode, code):
    for name in KNOWN_SOURCES:
        landing = land(root, name)
    land(root, "meta_ads", spend=-5.0, run="20260312_093000")
    args = ("--landing-path", landing, "--storage-path", f"{root}/store", "--gate", mode, *WINDOW)
    assert call(spark, "daily", *args) == code


def test_reversed_window(spark, root):
    with pytest.raises(ValueError):
        call(spark, "ingest", "--start-date", "2026-03-02", "--end-date", "2026-03-01")
