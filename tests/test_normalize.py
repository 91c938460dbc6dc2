from __future__ import annotations

from datetime import date
from functools import reduce

import pytest
from conftest import AT
from pyspark.sql import functions as F

from spendlake.errors import ReportLacksFields
from spendlake.operators.normalize import normalize, normalize_lenient, normalize_mixed
from spendlake.operators.union import union_strict
from spendlake.schemas import KNOWN_SOURCES, SILVER_COLUMNS, SILVER_SCHEMA
from spendlake.sources.registry import SOURCES, source_spec


def run(raw, name, **changes):
    return normalize(raw(name, **changes), SOURCES[name], "bronze/x.parquet", AT)


@pytest.mark.parametrize("name", KNOWN_SOURCES)
def test_schema_and_lineage(raw, name):
    df = run(raw, name)
    assert df.columns == SILVER_COLUMNS
    assert [f.dataType for f in df.schema] == [f.dataType for f in SILVER_SCHEMA]
    rows = df.collect()
    assert [r.date for r in rows] == [date(2026, 3, 1), date(2026, 3, 2)]
    assert {r.source for r in rows} == {name}
    assert {(r.source_file, r.transformed_at) for r in rows} == {("bronze/x.parquet", "2026-03-12T10:00:00")}


@pytest.mark.parametrize(
    "name, cost, impressions, clicks, conversions, campaigns, groups",
    [
        ("google_ads", [1234.5, 845.25], [7300, 5100], [410, 260], [31, 12],
         ["Garden tools", "Balcony pots"], ["Spades", "Clay"]),
        ("meta_ads", [310.75, 99.5], [9400, 2200], [655, 120], [48, 7],
         ["Winter boots", "Sandals"], ["Size 40 up", "Beach"]),
        ("tiktok_ads", [412.6, 208.15], [15800, 8700], [930, 333], [55, 21],
         ["Bike bells", "Bike lamps"], ["Riders", "Commuters"]),
    ],
)
def test_values(raw, name, cost, impressions, clicks, conversions, campaigns, groups):
    rows = run(raw, name).collect()
    assert [r.cost_brl for r in rows] == cost
    assert [r.impressions for r in rows] == impressions
    assert [r.clicks for r in rows] == clicks
    assert [r.conversions for r in rows] == conversions
    assert [r.campaign_name for r in rows] == campaigns
    assert [r.ad_group_name for r in rows] == groups


@pytest.mark.parametrize("name", KNOWN_SOURCES)
def test_missing_column_fails_without_a_job(raw, name):
    spec = SOURCES[name]
    for column in spec.required:
        with pytest.raises(ReportLacksFields) as caught:
            normalize(raw(name).drop(column), spec, "f.parquet", AT)
        assert column in str(caught.value)
        assert (caught.value.platform, caught.value.fields, caught.value.where) == (name, [column], "f.parquet")


def test_extra_columns_are_dropped(raw):
    df = normalize(raw("google_ads").withColumn("device", F.lit("x")), SOURCES["google_ads"], "f", AT)
    assert df.columns == SILVER_COLUMNS


@pytest.mark.parametrize(
    "name, change",
    [
        ("google_ads", {"date": "01/03/2026"}),
        ("google_ads", {"date": "2026-02-30"}),
        ("google_ads", {"date": "2026-3-1"}),
        ("google_ads", {"date": "2026-03-1T"}),
        ("google_ads", {"date": ""}),
        ("google_ads", {"conversions": float("nan")}),
        ("meta_ads", {"date_start": "2026-03-01"}),
        ("meta_ads", {"date_start": "31/02/2026"}),
        ("meta_ads", {"date_start": "1/3/2026"}),
        ("tiktok_ads", {"stat_time": "yesterday"}),
        ("tiktok_ads", {"total_cost": "R$ 12"}),
        ("tiktok_ads", {"total_cost": ""}),
        ("tiktok_ads", {"total_cost": "12.5d"}),
        ("tiktok_ads", {"total_cost": "0x1p3"}),
        ("tiktok_ads", {"total_cost": "12.5\n"}),
        ("tiktok_ads", {"total_cost": " 12.5"}),
        ("google_ads", {"date": "2026-03-01\n"}),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_value_fails_the_job(spark, raw, name, change, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=f"{name}.{next(iter(change))}: cannot read"):
            run(raw, name, **change).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_nulls_stay_null(raw):
    row = run(raw, "tiktok_ads", stat_time=None, total_cost=None, views=None, campaign_title=None).first()
    assert (row.date, row.cost_brl, row.impressions, row.campaign_name) == (None, None, None, None)


def test_fractional_conversions_are_truncated(raw):
    assert {r.conversions for r in run(raw, "google_ads", conversions=250.9).collect()} == {250}
    assert {r.conversions for r in run(raw, "google_ads", conversions=-1.9).collect()} == {-1}


def test_lenient_names_what_it_could_not_read(raw):
    spec = SOURCES["tiktok_ads"]
    df = normalize_lenient(raw("tiktok_ads", stat_time="soon", total_cost="n/a"), spec, "f", AT)
    for row in df.collect():
        assert (row.date, row.cost_brl, row.unparsed) == (None, None, ["date", "cost_brl"])
    clean = normalize_lenient(raw("tiktok_ads"), spec, "f", AT)
    assert clean.drop("unparsed").collect() == run(raw, "tiktok_ads").select(
        *[F.lit("f").alias(c) if c == "source_file" else c for c in SILVER_COLUMNS]
    ).collect()
    assert all(r.unparsed == [] for r in clean.collect())


def wide(raw):
    frames = [raw(name).withColumn("_source", F.lit(name)) for name in KNOWN_SOURCES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def test_mixed_equals_union(raw):
    mixed = normalize_mixed(wide(raw), "f", AT)
    union = union_strict([normalize(raw(n), SOURCES[n], "f", AT) for n in KNOWN_SOURCES])
    assert sorted(mixed.collect()) == sorted(union.collect())


def test_mixed_rejects_unknown_source(raw):
    bad = wide(raw).withColumn("_source", F.lit("other_ads"))
    with pytest.raises(Exception, match="unknown source other_ads"):
        normalize_mixed(bad, "f", AT).collect()


def test_mixed_reads_each_row_by_its_own_rules(raw):
    with pytest.raises(Exception, match="google_ads.date: cannot read 01/03/2026"):
        frame = wide(raw).withColumn("date", F.expr("CASE WHEN date IS NOT NULL THEN '01/03/2026' END"))
        normalize_mixed(frame, "f", AT).collect()


def test_union_is_strict(silver):
    with pytest.raises(ValueError, match="schemas differ"):
        union_strict([silver(), silver().withColumn("clicks", F.col("clicks").cast("int"))])
    assert union_strict([silver(), silver()]).count() == 10


def test_unknown_source_spec():
    with pytest.raises(KeyError):
        source_spec("other_ads")


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n", "\u0085", "\u2028", "\u2029", " ", "\t", "d", "f"])
def test_a_text_with_anything_behind_the_number_is_no_number(raw, end):
    rows = normalize_lenient(raw("tiktok_ads", total_cost=f"12.5{end}"), SOURCES["tiktok_ads"], "f", AT)
    assert {(r.cost_brl, tuple(r.unparsed)) for r in rows.collect()} == {(None, ("cost_brl",))}


@pytest.mark.parametrize("text", ["1e400", "-1e400", "Infinity", "NaN", "0x1p3", "", ".", "1e", "--1", "1.2.3", "e5", "+"])
def test_texts_that_are_no_number(raw, text):
    with pytest.raises(Exception, match="tiktok_ads.total_cost"):
        normalize(raw("tiktok_ads", total_cost=text), SOURCES["tiktok_ads"], "f", AT).collect()


@pytest.mark.parametrize("text, cost", [("1e3", 1000.0), ("+1.", 1.0), (".5", 0.5), ("-2.50E-1", -0.25), ("1e308", 1e308), ("007", 7.0)])
def test_texts_that_are_numbers(raw, text, cost):
    assert {r.cost_brl for r in normalize(raw("tiktok_ads", total_cost=text), SOURCES["tiktok_ads"], "f", AT).collect()} == {cost}
