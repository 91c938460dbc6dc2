from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import AT, GOLD_ROWS, RAW_ROWS
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.errors import QualityGateError
from spendlake.operators import merge as merging
from spendlake.operators.freshness import overall_status
from spendlake.plans.check import check, reports_by_source
from spendlake.plans.daily import run_daily
from spendlake.plans.health import dataset_health, layer_health
from spendlake.plans.ingest import ingest
from spendlake.plans.isolate import Results
from spendlake.plans.refine import refine
from spendlake.plans.runlog import append_run, output_info
from spendlake.plans.serve import serve_all, served, upsert
from spendlake.plans.summarize import latest_silver, summarize_all
from spendlake.schemas import GOLD_TABLES, KNOWN_SOURCES, ServedTypes
from spendlake.sources.landing import RECORD_COLUMNS, read_envelopes, unnest_envelope, with_ingest_columns
from spendlake.sources.registry import SOURCES
from spendlake.sources.scratch import scratch_path
from spendlake.sources.snapshots import latest_snapshot, write_gold_snapshot, write_snapshot

LATER = AT + timedelta(days=1)


def land(root, name, rows=None, key=None, file="report.json", run="20260312_090000", **changes):
    spec = SOURCES[name]
    records = [dict(zip(spec.raw_schema.names, r)) | changes for r in (RAW_ROWS[name] if rows is None else rows)]
    envelope = {"source": name, "total_rows": len(records), key or spec.envelope_key: records}
    folder = Path(root) / "landing" / name / f"landed={run}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_text(json.dumps(envelope))
    (folder / "_SUCCESS").touch()
    return f"{root}/landing"


# --- landing ---------------------------------------------------------------


@pytest.mark.parametrize("name", KNOWN_SOURCES)
def test_envelope_is_unnested(spark, root, name):
    landing = land(root, name)
    rows = unnest_envelope(read_envelopes(spark, SOURCES[name], f"{landing}/{name}"), SOURCES[name])
    assert rows.columns == [*SOURCES[name].raw_schema.names, *RECORD_COLUMNS]
    assert [tuple(r)[:-2] for r in rows.collect()] == RAW_ROWS[name]
    tagged = with_ingest_columns(rows, SOURCES[name], date(2026, 3, 12)).first()
    assert (tagged._source, tagged._ingested_at) == (name, "2026-03-12")


def test_missing_array_gives_no_rows(spark, root):
    landing = land(root, "google_ads", key="other")
    spec = SOURCES["google_ads"]
    assert unnest_envelope(read_envelopes(spark, spec, f"{landing}/google_ads"), spec).count() == 0


def test_envelopes_per_line_and_per_file(spark, tmp_path):
    spec = SOURCES["meta_ads"]
    record = dict(zip(spec.raw_schema.names, RAW_ROWS["meta_ads"][0]))
    lines = [json.dumps({"source": "meta_ads", "data": [record] * n}) for n in (1, 0, 3)]
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    assert unnest_envelope(read_envelopes(spark, spec, str(tmp_path)), spec).count() == 4
    whole = tmp_path / "whole"
    whole.mkdir()
    (whole / "r.json").write_text(json.dumps({"source": "meta_ads", "data": [record] * 2}, indent=1))
    assert unnest_envelope(read_envelopes(spark, spec, str(whole), many_lines=True), spec).count() == 2


def test_records_are_kept_as_they_came(spark, root):
    landing = land(root, "google_ads", device={"kind": "phone", "n": [1, 2]})
    results = ingest(spark, landing, f"{root}/bronze", at=AT)
    for r in spark.read.parquet(results["google_ads"].path).collect():
        assert json.loads(r._record)["device"] == {"kind": "phone", "n": [1, 2]}
        assert "device" in r._fields and r.clicks == json.loads(r._record)["clicks"]


def test_field_that_never_occurs_fails_its_platform(spark, root):
    names = [n for n in SOURCES["google_ads"].raw_schema.names if n != "cost_micros"]
    rows = [dict(zip(SOURCES["google_ads"].raw_schema.names, r)) for r in RAW_ROWS["google_ads"]]
    folder = Path(root) / "landing" / "google_ads" / "landed=20260312_090000"
    folder.mkdir(parents=True)
    (folder / "r.json").write_text(json.dumps({"rows": [{n: r[n] for n in names} for r in rows]}))
    (folder / "_SUCCESS").touch()
    land(root, "meta_ads", results=None)  # there, though null
    assert ingest(spark, f"{root}/landing", f"{root}/bronze", at=AT)["google_ads"].rows == len(rows)
    results = refine(spark, f"{root}/bronze", f"{root}/silver", AT)
    assert results["google_ads"] is None and "cost_micros" in results.errors["google_ads"]
    assert results["meta_ads"].rows == len(RAW_ROWS["meta_ads"])
    with pytest.raises(RuntimeError, match="cost_micros"):
        results.complete()


def test_fractional_counts_are_truncated_in_silver(spark, root):
    landing = land(root, "meta_ads", results=2.5)
    ingest(spark, landing, f"{root}/bronze", at=AT)
    refine(spark, f"{root}/bronze", f"{root}/silver", AT)
    assert {r.conversions for r in latest_silver(spark, f"{root}/silver").collect()} == {2}


def test_newest_finished_landing_run_is_read(spark, root):
    land(root, "google_ads", clicks=100)
    landing = land(root, "google_ads", clicks=110, run="20260313_090000")
    land(root, "google_ads", clicks=999, run="20260314_090000")
    (Path(landing) / "google_ads" / "landed=20260314_090000" / "_SUCCESS").unlink()
    results = ingest(spark, landing, f"{root}/bronze", at=AT)
    assert {r.clicks for r in spark.read.parquet(results["google_ads"].path).collect()} == {110}
    assert results.skipped == {"meta_ads": "no input", "tiktok_ads": "no input"}


def test_ingest_isolates_sources(spark, root):
    land(root, "google_ads")
    land(root, "meta_ads", rows=[])
    landing = land(root, "tiktok_ads", views="many")
    results = ingest(spark, landing, f"{root}/bronze", at=AT)
    assert results["google_ads"].rows == 2
    assert results["google_ads"].path.endswith("google_ads/snapshot=20260312_100000")
    assert results["meta_ads"] is None and results["tiktok_ads"] is None
    bronze = spark.read.parquet(results["google_ads"].path)
    assert bronze.columns == [*SOURCES["google_ads"].raw_schema.names, *RECORD_COLUMNS, "_source", "_ingested_at"]
    assert list(results.skipped) == ["meta_ads"] and list(results.errors) == ["tiktok_ads"]


def test_ingest_window(spark, root):
    for name in KNOWN_SOURCES:
        landing = land(root, name)
    day = date(2026, 3, 2)
    results = ingest(spark, landing, f"{root}/bronze", window=(day, day), at=AT)
    assert {r.rows for r in results.values()} == {1}
    with pytest.raises(ValueError):
        ingest(spark, landing, f"{root}/bronze", window=(day, day - timedelta(days=1)))
    with pytest.raises(ValueError):
        ingest(spark, landing, f"{root}/bronze", window=(day, day + timedelta(days=91)))
    long = ingest(spark, landing, f"{root}/bronze", window=(day, day + timedelta(days=400)), at=AT, max_days=None)
    assert {r.rows for r in long.values()} == {1}


# --- snapshots -------------------------------------------------------------


def test_latest_snapshot_by_name(spark, silver, tmp_path):
    root = str(tmp_path)
    assert latest_snapshot(spark, root, "google_ads") is None
    (tmp_path / "google_ads").mkdir()
    (tmp_path / "google_ads" / "notes.txt").write_text("x")
    assert latest_snapshot(spark, root, "google_ads") is None
    for at in (datetime(2026, 3, 12, 14, 30), datetime(2026, 3, 10, 8), datetime(2026, 3, 11, 12)):
        write_snapshot(silver(), root, "google_ads", at)
    assert latest_snapshot(spark, root, "google_ads").endswith("snapshot=20260312_143000")


def test_unfinished_snapshot_is_not_seen(spark, silver, tmp_path):
    write_snapshot(silver(), str(tmp_path), "google_ads", AT)
    (tmp_path / "google_ads" / "snapshot=20270101_000000").mkdir()
    assert latest_snapshot(spark, str(tmp_path), "google_ads").endswith("snapshot=20260312_100000")


def test_single_files_are_snapshots_too(spark, silver, tmp_path):
    folder = tmp_path / "google_ads"
    folder.mkdir()
    for stamp in ("20260310_080000", "20260312_143000", "20260311_120000"):
        silver().toPandas().to_parquet(folder / f"google_ads_{stamp}.parquet")
    assert latest_snapshot(spark, str(tmp_path), "google_ads").endswith("google_ads_20260312_143000.parquet")
    write_snapshot(silver(), str(tmp_path), "google_ads", datetime(2026, 3, 12, 15))
    assert latest_snapshot(spark, str(tmp_path), "google_ads").endswith("snapshot=20260312_150000")


def test_empty_and_unknown_are_refused(silver, root):
    with pytest.raises(ValueError, match="empty"):
        write_snapshot(silver([]), root, "google_ads")
    with pytest.raises(ValueError, match="unknown gold table"):
        write_gold_snapshot(silver(), root, "other")


def test_same_second_adds(spark, silver, root):
    first = write_snapshot(silver(), root, "google_ads", AT)
    again = write_snapshot(silver().limit(1), root, "google_ads", AT)
    assert again.rows == 1 and spark.read.parquet(again.path).count() == 1
    assert spark.read.parquet(first.path).count() == silver().count()
    assert latest_snapshot(spark, root, "google_ads").endswith(again.path.split("/")[-1])


def test_nothing_is_left_of_an_empty_snapshot(spark, silver, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        write_snapshot(silver([]), str(tmp_path), "google_ads", AT)
    assert not list((tmp_path / "google_ads").iterdir())


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# --- bronze to gold --------------------------------------------------------


def bronze(raw, root, names=KNOWN_SOURCES, **changes):
    for name in names:
        write_snapshot(raw(name, **changes), f"{root}/bronze", name, AT)
    return f"{root}/bronze"


def test_refine(spark, raw, root):
    results = refine(spark, bronze(raw, root), f"{root}/silver", AT)
    assert {r.rows for r in results.values()} == {2}
    silver = latest_silver(spark, f"{root}/silver")
    assert silver.count() == 6
    files = {r.source: r.source_file for r in silver.collect()}
    assert files["meta_ads"].endswith("bronze/meta_ads/snapshot=20260312_100000")


def test_refine_can_set_rows_aside(spark, raw, root):
    mixed = raw("tiktok_ads").withColumn("total_cost", F.expr("CASE WHEN views > 10000 THEN '1d' ELSE total_cost END"))
    write_snapshot(mixed, f"{root}/bronze", "tiktok_ads", AT)
    write_snapshot(raw("meta_ads", link_clicks=-1), f"{root}/bronze", "meta_ads", AT)
    results = refine(spark, f"{root}/bronze", f"{root}/silver", AT, f"{root}/aside", contract=True, lenient=True)
    assert results["tiktok_ads"].rows == 1 and results["meta_ads"] is None
    unread = spark.read.parquet(latest_snapshot(spark, f"{root}/aside/unparsed", "tiktok_ads")).collect()
    assert [r.unparsed for r in unread] == [["cost_brl"]]
    assert spark.read.parquet(latest_snapshot(spark, f"{root}/aside/contract", "meta_ads")).count() == 2


def test_refine_takes_the_latest_and_isolates(spark, raw, root):
    bronze(raw, root, ["google_ads"])
    write_snapshot(raw("google_ads").limit(1), f"{root}/bronze", "google_ads", LATER)
    write_snapshot(raw("meta_ads", date_start="2026-03-01"), f"{root}/bronze", "meta_ads", AT)
    results = refine(spark, f"{root}/bronze", f"{root}/silver", LATER)
    assert results["google_ads"].rows == 1
    assert results["meta_ads"] is None and results["tiktok_ads"] is None
    assert latest_snapshot(spark, f"{root}/silver", "meta_ads") is None


def test_summarize_all(spark, raw, root):
    refine(spark, bronze(raw, root), f"{root}/silver", AT)
    results = summarize_all(spark, f"{root}/silver", f"{root}/gold", AT)
    assert {t: r.rows for t, r in results.items()} == {
        "daily_summary": 6, "campaign_summary": 6, "source_comparison": 3,
    }
    by_cost = spark.read.parquet(results["source_comparison"].path).orderBy(F.desc("cost_brl")).collect()
    assert [(r.source, r.cost_brl) for r in by_cost] == [
        ("google_ads", 2079.75), ("tiktok_ads", 620.75), ("meta_ads", 410.25),
    ]


def test_summarize_without_silver(spark, root):
    assert set(summarize_all(spark, f"{root}/none", f"{root}/gold").values()) == {None}


def test_summarize_isolates_tables(spark, silver, root):
    write_snapshot(silver().drop("campaign_name"), f"{root}/silver", "google_ads", AT)
    results = summarize_all(spark, f"{root}/silver", f"{root}/gold", AT)
    assert results["campaign_summary"] is None
    assert results["daily_summary"].rows == 4 and results["source_comparison"].rows == 2


# --- served tables ---------------------------------------------------------

@pytest.mark.parametrize("table", GOLD_TABLES)
def test_upsert_inserts_and_is_idempotent(spark, gold, root, table):
    assert upsert(spark, root, table, gold(table), AT) == 2
    first = served(spark, root, table).orderBy("source").collect()
    assert upsert(spark, root, table, gold(table), LATER) == 2
    assert served(spark, root, table).orderBy("source").collect() == first
    assert {r.loaded_at for r in first} == {AT}
    assert dict(served(spark, root, table).dtypes)["cost_brl"] == "decimal(14,6)"
    assert dict(served(spark, root, table).dtypes)["ctr_pct"] == "decimal(10,4)"


def test_upsert_updates_in_place_and_keeps_the_rest(spark, gold, root):
    upsert(spark, root, "daily_summary", gold("daily_summary"), AT)
    fresh = (date(2026, 3, 3), "google_ads", 1, 1, 1.0, 1, 100.0, 1.0, 1000.0, 1.0)
    changed = [(date(2026, 3, 1), "google_ads", 999999, *GOLD_ROWS["daily_summary"][0][3:]), fresh]
    assert upsert(spark, root, "daily_summary", gold("daily_summary", changed), LATER) == 2
    rows = {(r.date.day, r.source): r for r in served(spark, root, "daily_summary").collect()}
    assert len(rows) == 3
    assert rows[1, "google_ads"].impressions == 999999 and rows[1, "google_ads"].loaded_at == AT
    assert rows[2, "meta_ads"].impressions == 3000 and rows[2, "meta_ads"].loaded_at == AT
    assert rows[3, "google_ads"].loaded_at == LATER


def test_upsert_of_nothing_and_of_unknown(spark, gold, root):
    assert upsert(spark, root, "daily_summary", gold("daily_summary").limit(0), AT) == 0
    assert served(spark, root, "daily_summary").count() == 0
    with pytest.raises(KeyError):
        upsert(spark, root, "other", gold("daily_summary"), AT)


@pytest.mark.parametrize(
    "change, message",
    [
        ({"source": None}, "served source is null"),
        ({"clicks": None}, "served clicks is null"),
        ({"cost_brl": 1e8}, "served cost_brl"),
        ({"cpa_brl": 1e6}, "served cpa_brl"),
        ({"source": "x" * 51}, "served source .at most 50 characters"),
        ({"date": date(2026, 3, 1), "source": "google_ads"}, "duplicate key 2026-03-01, google_ads"),
    ],
)
def test_bad_batches_fail_and_leave_the_table(spark, gold, root, change, message):
    upsert(spark, root, "daily_summary", gold("daily_summary"), AT)
    with pytest.raises(Exception, match=message):
        upsert(spark, root, "daily_summary", gold("daily_summary", **change), LATER)
    assert served(spark, root, "daily_summary").count() == 2


def test_wider_types(spark, gold):
    wide = ServedTypes(T.DecimalType(20, 6))
    row = merging.as_served(gold("daily_summary", cost_brl=1e8), "daily_summary", wide).first()
    assert row.cost_brl == 10**8


def test_merge_shuffles_each_side_once(spark, gold, root):
    upsert(spark, root, "campaign_summary", gold("campaign_summary"), AT)
    gold("campaign_summary").write.parquet(f"{root}/batch")
    merged = merging.merge(
        served(spark, root, "campaign_summary").hint("merge"),
        spark.read.parquet(f"{root}/batch"),
        "campaign_summary",
        LATER,
    )
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2


def test_serve_all_isolates(spark, gold, root):
    write_gold_snapshot(gold("daily_summary"), f"{root}/gold", "daily_summary", AT)
    write_gold_snapshot(gold("source_comparison", clicks=None), f"{root}/gold", "source_comparison", AT)
    assert serve_all(spark, f"{root}/gold", f"{root}/served", AT) == {
        "daily_summary": 2, "campaign_summary": None, "source_comparison": None,
    }


# --- whole run, health, run log --------------------------------------------


def test_run_daily_twice(spark, root):
    for name in KNOWN_SOURCES:
        landing = land(root, name)
    for at in (AT, LATER):
        result = run_daily(spark, landing, f"{root}/store", at=at)
    assert list(result.stages) == ["ingest", "refine", "summarize", "serve"]
    assert result.stages["serve"] == {"daily_summary": 6, "campaign_summary": 6, "source_comparison": 3}
    assert result.failed_quality == []
    assert {r.loaded_at for r in served(spark, f"{root}/store/served", "daily_summary").collect()} == {AT}
    log = spark.read.parquet(f"{root}/store/run_log").where("stage = 'serve'").collect()
    assert len(log) == 6
    assert {(r.items_ok, r.items_failed, r.rows_total, r.status) for r in log} == {(3, 0, 15, "ok")}


def test_gate_stops_or_warns(spark, root):
    for name in KNOWN_SOURCES:
        landing = land(root, name)
    land(root, "google_ads", clicks=200001, run="20260312_093000")
    with pytest.raises(QualityGateError):
        run_daily(spark, landing, f"{root}/store", at=AT)
    assert latest_snapshot(spark, f"{root}/store/gold", "daily_summary") is None
    result = run_daily(spark, landing, f"{root}/store", gate_mode="warn", at=LATER)
    assert result.failed_quality == ["google_ads"]
    assert result.stages["serve"]["daily_summary"] == 6


def test_overlapping_reports_are_not_added_up(spark, root):
    """A day that a later report restates counts once, as restated."""
    day = lambda d, n: (f"2026-03-{d:02d}", "C", "G", n, n // 2, n * 10_000, 1.0, "BRL")
    land(root, "google_ads", [day(1, 100)])
    run_daily(spark, f"{root}/landing", f"{root}/store", at=AT)
    landing = land(root, "google_ads", [day(1, 110), day(2, 50)], run="20260313_090000")
    run_daily(spark, landing, f"{root}/store", at=LATER)
    rows = {r.date.day: r for r in served(spark, f"{root}/store/served", "daily_summary").collect()}
    assert {d: (r.impressions, float(r.cost_brl)) for d, r in rows.items()} == {1: (110, 1.1), 2: (50, 0.5)}


def test_run_without_input_fails(spark, root):
    with pytest.raises(RuntimeError, match="summarize"):
        run_daily(spark, f"{root}/landing", f"{root}/store", at=AT)


def test_check_after_refine(spark, raw, root):
    refine(spark, bronze(raw, root), f"{root}/silver", AT)
    reports = reports_by_source(check(spark, f"{root}/silver"))
    assert reports.count() == 54 and reports.where("NOT success").count() == 0


def test_health(spark, silver, root):
    degraded = layer_health(spark, root)
    assert {(r.layer, r.ok, r.message) for r in degraded.collect()} == {
        (layer, False, "no parquet files") for layer in ("bronze", "silver", "gold")
    }
    assert overall_status(degraded).first().status == "degraded"
    for layer in ("bronze", "silver", "gold"):
        write_snapshot(silver(), f"{root}/{layer}", "google_ads", AT)
    now = datetime.now()
    assert overall_status(layer_health(spark, root, now)).first().status == "healthy"
    stale = layer_health(spark, root, now + timedelta(hours=30)).collect()
    assert {r.ok for r in stale} == {False} and all(r.message.endswith("h old") for r in stale)
    datasets = dataset_health(spark, root, now).collect()
    assert {(r.layer, r.dataset, r.ok) for r in datasets} == {
        (layer, "google_ads", True) for layer in ("bronze", "silver", "gold")
    }


def test_output_info_and_run_log(spark, silver, root):
    written = write_snapshot(silver(), root, "google_ads", AT)
    files = [p for p in Path(written.path).glob("*.parquet")]
    info = output_info(spark, written)
    assert info == {
        "status": "ok",
        "path": written.path,
        "size_kb": pytest.approx(sum(p.stat().st_size for p in files) / 1024, abs=0.005),
    }
    assert output_info(spark, None) == {"status": "failed"}
    append_run(spark, f"{root}/log", "refine", {"google_ads": written, "meta_ads": None}, 1.234, AT)
    rows = {r.item: r for r in spark.read.parquet(f"{root}/log").collect()}
    assert (rows["google_ads"].rows, rows["google_ads"].status) == (5, "ok")
    assert (rows["meta_ads"].rows, rows["meta_ads"].status) == (None, "failed")
    done = Results({"a": 1, "b": None, "c": None}, errors={"b": "broken"}, skipped={"c": "no input"})
    append_run(spark, f"{root}/log2", "serve", done, 1.0, AT)
    states = {r.item: (r.status, r.error) for r in spark.read.parquet(f"{root}/log2").collect()}
    assert states == {"a": ("ok", None), "b": ("failed", "broken"), "c": ("skipped", "no input")}
    assert {(r.items_ok, r.items_failed, r.duration_seconds) for r in rows.values()} == {(1, 1, 1.23)}
