from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlake.functions.casts import rounded
from spendlake.functions.dates import (
    check_window,
    date_spine,
    date_window,
    day_month_year,
    iso_date,
    lenient_date,
    missing_days,
)

FALLBACK = date(1990, 1, 1)


def python_date(text):
    try:
        return date.fromisoformat(text) if text else FALLBACK
    except ValueError:
        return FALLBACK


def apply(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.d for r in df.selectExpr("i", f"{expression} AS d").orderBy("i").collect()]


TEXTS = [
    None, "", "2026-03-01", "20260301", "2026-W09-7", "2026W097", "2026-W09", "2026W09", "2026-W53-1",
    "2020-W53-7", "2026-W00-1", "2026-W09-0", "2026-W09-8", "2026W09-7", "2026-W097", "2026-02-30", "20260230",
    "2026-3-1", "01/03/2026", "not a date", "0000-01-01", "0001-01-01", "9999-12-31", "2024-02-29", "2023-02-29",
    "2026-03-01 ", " 2026-03-01", "2026-03-01T00:00", "2019-W01-1", "2018-W53-1", "0000W011", "2026-03", "2026",
]


def test_lenient_date_is_iso_8601(spark):
    assert apply(spark, lenient_date("t", FALLBACK), TEXTS) == [python_date(t) for t in TEXTS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.dates(), st.sampled_from(["%Y-%m-%d", "%Y%m%d", "week"])), min_size=200, max_size=200))
def test_lenient_date_on_any_date(spark, days):
    texts = []
    for day, form in days:
        year, week, weekday = day.isocalendar()
        if form == "week" and year <= 9999:
            texts.append(f"{year:04d}-W{week:02d}-{weekday}")
        else:
            texts.append(day.isoformat() if form != "%Y%m%d" else day.isoformat().replace("-", ""))
    assert apply(spark, lenient_date("t", FALLBACK), texts) == [python_date(t) for t in texts]


def test_iso_date_is_strict(spark):
    good, bad = ["2026-03-01", "2024-02-29"], ["2026-3-1", "2026-03-1T", "2026-03-01 ", "2026-02-30", "2026-03-01\n", "", None]
    assert apply(spark, iso_date("t"), good) == [date(2026, 3, 1), date(2024, 2, 29)]
    assert set(apply(spark, iso_date("t"), bad)) == {None}


def test_day_month_year_is_strict(spark):
    bad = ["1/3/2026", "31/02/2026", "2026-03-01", "01/13/2026", "01/03/26", "", None]
    assert apply(spark, day_month_year("t"), ["01/03/2026"]) == [date(2026, 3, 1)]
    assert set(apply(spark, day_month_year("t"), bad)) == {None}


def test_spine(spark):
    days = [r.date for r in date_spine(spark, date(2024, 2, 27), date(2024, 3, 2)).orderBy("date").collect()]
    assert days == [date(2024, 2, 27) + timedelta(days=i) for i in range(5)]
    assert date_spine(spark, date(2024, 1, 1), date(2024, 1, 1)).count() == 1
    with pytest.raises(ValueError):
        date_spine(spark, date(2024, 1, 2), date(2024, 1, 1))


def test_window(silver):
    assert date_window(silver(), date(2026, 3, 1), date(2026, 3, 1)).count() == 3
    assert date_window(silver(), date(2026, 3, 1), date(2026, 3, 2)).count() == 5
    check_window(date(2026, 1, 1), date(2026, 4, 1))  # 90 days apart
    with pytest.raises(ValueError):
        check_window(date(2026, 1, 1), date(2026, 4, 2))
    check_window(date(2026, 1, 1), date(2030, 1, 1), max_days=None)


def test_window_reaches_the_scan(spark, silver, root):
    silver().write.parquet(f"{root}/s")
    rows = date_window(spark.read.parquet(f"{root}/s"), date(2026, 3, 1), date(2026, 3, 1)).select("clicks")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2026-03-01)" in plan and "LessThanOrEqual(date,2026-03-01)" in plan
    assert "ReadSchema: struct<date:date,clicks:bigint>" in plan


def test_missing_days(silver):
    row = ("C", "G", 1, 1, 1.0, 1)
    rows = [(date(2026, 3, d), "google_ads", *row) for d in (1, 1, 2, 5, 6)]
    rows += [(date(2026, 3, d), "meta_ads", *row) for d in (3, 4)] + [(None, "meta_ads", *row)]
    rows += [(date(2026, 3, 1), None, *row), (date(2026, 3, 9), None, *row)]
    gaps = {(r.source, r.date.day) for r in missing_days(silver(rows)).collect()}
    assert gaps == {("google_ads", 3), ("google_ads", 4)} | {(None, d) for d in range(2, 9)}


def test_rounding_breaks_ties_to_even(spark):
    values = [0.00005, 0.00015, 1.00025, 0.5 / 10000, 2.5 / 10000, -1.5 / 10000, -2.5, 4.66666666]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.d for r in df.selectExpr("i", f"{rounded('v', 4)} AS d").orderBy("i").collect()]
    assert got == [round(v * 10000) / 10000 for v in values]
