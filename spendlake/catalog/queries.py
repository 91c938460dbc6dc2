"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.catalog import derive
from spendlake.functions.dates import date_window, lenient_date, missing_days, spine_per_source
from spendlake.operators import aggregate, contract, freshness, merge, quality
from spendlake.operators.normalize import normalize, normalize_lenient, normalize_mixed
from spendlake.operators.union import union_strict
from spendlake.plans.check import check, reports_by_source
from spendlake.plans.health import committed_health, dataset_health, layer_files
from spendlake.plans.ingest import ingest
from spendlake.plans.isolate import each
from spendlake.plans.refine import refine
from spendlake.plans.refine_once import check_kept, refine_once
from spendlake.plans.runlog import RUN_LOG_SCHEMA, append_run
from spendlake.plans.serve import serve_all, served
from spendlake.plans.serve_together import serve_together, served_version
from spendlake.plans.summarize import latest_silver, summarize_all
from spendlake.plans.totals import summarize_restated
from spendlake.schemas import GOLD_TABLES, KNOWN_SOURCES, METRICS, RATIOS, SILVER_SCHEMA, ServedTypes
from spendlake.sources.buckets import read_manifest
from spendlake.sources.drift import drift_report
from spendlake.sources.landing import RECORD_COLUMNS, unnest_envelope, with_ingest_columns
from spendlake.sources.registry import SOURCES
from spendlake.sources.scratch import scratch_path
from spendlake.sources.snapshots import Written, latest_snapshot, read_snapshot, write_snapshot

Query = Callable[[SparkSession, str], DataFrame]

AT = datetime(2026, 3, 12, 10, 0, 0)
LATER = datetime(2026, 3, 13, 10, 0, 0)
# Wide enough for the totals of any table size; the served default is decimal(14,6) and decimal(10,4).
WIDE = ServedTypes(T.DecimalType(28, 6), T.DecimalType(20, 4))
REPORTS_A_FILE = 200_000


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem as silver: one scan, one projection."""
    return normalize_mixed(derive.raw_mixed(derive.lineitem(spark, sf_dir)), "lineitem", AT)


def _normalized(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = SOURCES[name]
        raw = derive.raw_report(derive.lineitem(spark, sf_dir), spec)
        return normalize(raw, spec, "lineitem", AT)

    return query


def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derive.lineitem(spark, sf_dir)
    frames = []
    for name, spec in SOURCES.items():
        raw = derive.raw_report(derive.own_lines(lines, name), spec)
        frames.append(normalize(raw, spec, f"{name}.parquet", AT))
    return union_strict(frames)


def silver_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable dates and costs: NULL in silver, named in ``unparsed``."""
    spec = SOURCES["tiktok_ads"]
    raw = derive.raw_report(derive.lineitem(spark, sf_dir), spec).withColumns(
        {
            "stat_time": F.expr(
                """CASE views WHEN 5000 THEN 'yesterday' WHEN 4600 THEN concat(left(stat_time, 9), chr(10))
                   ELSE stat_time END"""
            ),
            "total_cost": F.expr(
                """CASE views WHEN 5000 THEN 'n/a' WHEN 4900 THEN concat(total_cost, 'd') WHEN 4800 THEN '0x1p3'
                   WHEN 4700 THEN concat(total_cost, chr(10)) WHEN 4500 THEN concat(total_cost, chr(13))
                   WHEN 4400 THEN concat(total_cost, chr(13), chr(10)) WHEN 4300 THEN concat(total_cost, '\u0085')
                   WHEN 4200 THEN concat(total_cost, '\u2028') WHEN 4100 THEN '1e400' WHEN 4000 THEN concat(' ', total_cost)
                   ELSE total_cost END"""
            ),
        }
    )
    silver = normalize_lenient(raw, spec, "lineitem", AT)
    return silver.withColumn("unparsed", F.concat_ws(",", "unparsed"))


def derived_metrics_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver(spark, sf_dir).select(
        "date", "source", "campaign_name", "ad_group_name", "impressions", "clicks", "cost_brl", "conversions"
    )
    return aggregate.with_ratios(rows)


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.damaged(derive.lineitem(spark, sf_dir))


def row_contract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.contract_valid(_damaged(spark, sf_dir))


def row_contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.contract_quarantine(_damaged(spark, sf_dir))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_damaged(spark, sf_dir), "lineitem")


def quality_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_failures(quality_report(spark, sf_dir))


def _quality_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_damaged(spark, sf_dir), F.col("source_dir"))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = quality.quality_summary(_quality_by_source(spark, sf_dir))
    return quality.with_missing_sources(summary, (*KNOWN_SOURCES, "another_source"))


def quality_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = _damaged(spark, sf_dir).drop("clicks", "source_file")
    return quality.quality_report(partial, "lineitem")


def _daily(spark: SparkSession, sf_dir: str, keep: str) -> DataFrame:
    """Daily totals of some days, unordered; the filter on the ship date reaches the scan."""
    lines = derive.lineitem(spark, sf_dir).where(keep)
    return aggregate.summarize(normalize_mixed(derive.raw_mixed(lines), "lineitem", AT), "daily_summary")


def _as_text(rows: DataFrame) -> DataFrame:
    """Decimals as text, so that the comparison sees every digit."""
    decimals = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return rows.withColumns({c: F.col(c).cast("string") for c in decimals})


def served_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _daily(spark, sf_dir, "true")
    return _as_text(merge.as_served(gold, "daily_summary", WIDE))


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days before July 1998 are served; a restated batch from January 1998 on comes in."""
    stored = merge.merge(
        merge.empty_served(spark, "daily_summary", WIDE),
        _daily(spark, sf_dir, "l_shipdate < timestamp'1998-07-01'"),
        "daily_summary",
        AT,
        WIDE,
    )
    batch = _daily(spark, sf_dir, "l_shipdate >= timestamp'1998-01-01'").withColumn(
        "impressions", F.col("impressions") * 2
    )
    return _as_text(merge.merge(stored, batch, "daily_summary", LATER, WIDE))


def latest_snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of orders, the later one with raised prices, and a write that never finished."""
    root, orders = scratch_path(spark, "orders"), derive.table(spark, sf_dir, "orders")
    write_snapshot(orders, root, "orders", AT)
    write_snapshot(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), root, "orders", LATER)
    orders.limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{root}/orders/snapshot=20991231_000000"
    )
    latest = read_snapshot(spark, latest_snapshot(spark, root, "orders"), orders.schema)
    return latest.select("o_orderkey", "o_custkey", "o_totalprice")


def date_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window over a stored DATE, which reaches the scan."""
    root = scratch_path(spark, "window")
    path = write_snapshot(_silver(spark, sf_dir), root, "all", AT).path
    return date_window(read_snapshot(spark, path, SILVER_SCHEMA), date(1998, 1, 1), date(1998, 3, 31))


def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spine_per_source(_silver(spark, sf_dir))


def date_spine_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_days(_silver(spark, sf_dir))


def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in several spellings, by order status and priority; week dates with line ends count as unreadable."""
    week = "concat(extract(YEAROFWEEK FROM o_orderdate), '-W', lpad(weekofyear(o_orderdate), 2, '0'), '-', weekday(o_orderdate) + 1)"
    texts = derive.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"""CASE left(o_orderpriority, 1)
             WHEN '1' THEN cast(cast(o_orderdate AS date) AS string)
             WHEN '2' THEN date_format(o_orderdate, 'yyyyMMdd')
             WHEN '3' THEN {week}
             WHEN '4' THEN CASE o_orderkey % 6
                             WHEN 0 THEN date_format(o_orderdate, 'dd/MM/yyyy')
                             WHEN 1 THEN concat({week}, chr(13))
                             WHEN 2 THEN concat(left({week}, 8), chr(13), chr(10))
                             WHEN 3 THEN concat(replace({week}, '-', ''), '\u0085')
                             WHEN 4 THEN concat(left({week}, 8), '\u2028')
                             ELSE concat(date_format(o_orderdate, 'yyyyMMdd'), chr(13)) END
             ELSE CASE o_orderstatus
                    WHEN 'F' THEN ''
                    WHEN 'O' THEN concat(date_format(o_orderdate, 'yyyy-MM-'), '32') END
           END AS text""",
    )
    return texts.selectExpr("o_orderkey", f"{lenient_date('text', date(1990, 1, 1))} AS day")


def envelope_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one JSON report: two records, none, or no array at all."""
    spec = SOURCES["google_ads"]
    record = """named_struct('date', date_format(ts, 'yyyy-MM-dd'), 'campaign_name', event_type,
        'ad_group_name', concat('User ', user_id), 'impressions', k * {times}, 'clicks', k,
        'cost_micros', floor(value * 1e6D + 0.5D), 'conversions', value, 'currency', 'BRL')"""
    rows = f"array({record.format(times=100)}, {record.format(times=200)})"
    reports = (
        derive.table(spark, sf_dir, "events")
        .withColumn("k", F.expr("cast(get_json_object(props, '$.k') AS bigint)"))
        .selectExpr(
            f"""CASE event_type
                  WHEN 'error' THEN '{{"source": "google_ads", "total_rows": 0}}'
                  WHEN 'signup' THEN '{{"source": "google_ads", "total_rows": 0, "rows": []}}'
                  ELSE to_json(named_struct('source', 'google_ads', 'total_rows', 2, 'rows', {rows}))
                END AS text"""
        )
    )
    parsed = F.from_json("text", spec.envelope_schema(), {"mode": "FAILFAST"}).alias("report")
    envelopes = reports.select(parsed).select("report.*")
    return with_ingest_columns(unnest_envelope(envelopes, spec).drop(*RECORD_COLUMNS), spec, AT.date())


def distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.distinct_sources(_silver(spark, sf_dir))


def _event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a file of its type's layer, named by its user and number."""
    return derive.table(spark, sf_dir, "events").selectExpr(
        "event_type AS layer",
        "format_string('%s/u%06d/part-%010d.parquet', event_type, user_id, event_id) AS path",
        "cast(ts AS timestamp) AS modified_at",
        "event_id AS bytes",
    )


def _as_of() -> Column:
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def layer_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.freshness(_event_files(spark, sf_dir), ["layer"], _as_of())


def layer_freshness_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.freshness(_event_files(spark, sf_dir), ["layer"], _as_of(), newest=True)


def overall_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = ("click", "error", "purchase", "signup", "view", "silver")
    status = layer_freshness_newest(spark, sf_dir)
    return freshness.overall_status(freshness.with_missing_layers(status, layers))


def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.size_kb(_event_files(spark, sf_dir))


def _bronze(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Two bronze snapshots per platform: an old one of open lines, then the full one."""
    lines = derive.lineitem(spark, sf_dir)

    def write(name: str) -> Written:
        spec, mine = SOURCES[name], derive.own_lines(lines, name)
        old = derive.raw_report(mine.where("l_linestatus = 'O'"), spec)
        write_snapshot(with_ingest_columns(old, spec, AT.date()), f"{root}/bronze", name, AT)
        full = derive.raw_report(mine, spec)
        return write_snapshot(with_ingest_columns(full, spec, LATER.date()), f"{root}/bronze", name, LATER)

    each(spark, "bronze", SOURCES, write).complete()
    return f"{root}/bronze"


def refined_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze snapshots on storage -> latest ones -> silver snapshots -> their union."""
    root = scratch_path(spark, "refined")
    refine(spark, _bronze(spark, sf_dir, root), f"{root}/silver", LATER).complete()
    return _with_file_names(latest_silver(spark, f"{root}/silver"))


def _with_file_names(silver: DataFrame) -> DataFrame:
    """The lineage without the folder the query made up: dataset and snapshot only."""
    return silver.withColumn("source_file", F.substring_index("source_file", "/", -2))


def _land(spark: SparkSession, lines: DataFrame, landing: str, run: str, records: tuple[str, ...] = ("struct(*)",)) -> None:
    """A landing run of every platform: each line as a report of its own, one per line of JSON, in compressed files.

    No split of a compressed file can be read alone, so what one holds is bounded.
    """

    def land(name: str) -> str:
        spec = SOURCES[name]
        mine = derive.own_lines(lines, name)
        raw = derive.raw_report(mine, spec, extra=[c for c in mine.columns if c.startswith("extra_")])
        report = f"""named_struct('source', '{name}', 'total_rows', {len(records)}L,
                                  '{spec.envelope_key}', array({", ".join(records)})) AS report"""
        rows = raw.selectExpr(report).select("report.*").write.option("compression", "lz4")
        rows.option("maxRecordsPerFile", REPORTS_A_FILE).json(f"{landing}/{name}/landed={run}")
        return name

    each(spark, "land", SOURCES, land).complete()


def landed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON reports, one per line -> bronze -> silver -> their union."""
    root = scratch_path(spark, "landed")
    _land(spark, derive.lineitem(spark, sf_dir), f"{root}/landing", "20260312_090000")
    ingest(spark, f"{root}/landing", f"{root}/bronze", at=AT).complete()
    refine(spark, f"{root}/bronze", f"{root}/silver", AT).complete()
    return _with_file_names(latest_silver(spark, f"{root}/silver"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of text as compressed blocks, and their sizes before."""
    for batch in batches:
        text = "\n".join(batch.column(0).to_pylist()).encode()
        block = pa.compress(text, codec="zstd", asbytes=True)
        yield pa.RecordBatch.from_pydict({"block": [block], "size": [len(text)]})


def _unpacked(begin: str, end: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The text of the blocks of one partition, between a beginning and an end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [begin]})
        for batch in batches:
            for block, size in zip(*(c.to_pylist() for c in batch.columns)):
                text = pa.decompress(block, size, codec="zstd", asbytes=True).decode()
                yield pa.RecordBatch.from_pydict({"value": [text]})
        yield pa.RecordBatch.from_pydict({"value": [end]})

    return run


def _land_document(spark: SparkSession, lines: DataFrame, landing: str, run: str) -> None:
    """A landing run of every platform: all its lines as one JSON document in one file, over many lines of text.

    Records become text in many tasks; the one that writes the file only copies it.
    """

    def land(name: str) -> str:
        spec = SOURCES[name]
        records = derive.raw_report(derive.own_lines(lines, name), spec).selectExpr("concat(', ', to_json(struct(*))) AS value")
        begin = f"""{{"source": "{name}", "total_rows": 1, "paging": {{"next": []}},\n "{spec.envelope_key}": [null"""
        # The empty line keeps the partition, which has to write a document, where there are no records.
        rows = spark.range(1).select(F.lit("").alias("value")).union(records)
        blocks = rows.mapInArrow(_packed, "block binary, size long").repartition(1)
        blocks.mapInArrow(_unpacked(begin, "]}"), "value string").write.text(f"{landing}/{name}/landed={run}")
        return name

    each(spark, "land", SOURCES, land).complete()


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document a platform with all its records, read by several tasks -> bronze -> silver -> their union."""
    root = scratch_path(spark, "documents")
    _land_document(spark, derive.lineitem(spark, sf_dir), f"{root}/landing", "20260312_090000")
    ingest(spark, f"{root}/landing", f"{root}/bronze", at=AT, many_lines=True).complete()
    refine(spark, f"{root}/bronze", f"{root}/silver", AT).complete()
    return _with_file_names(latest_silver(spark, f"{root}/silver"))


def overlapping_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs; the second report restates days of the first with other metrics."""
    root, lines = scratch_path(spark, "overlap"), derive.lineitem(spark, sf_dir)
    restated = lines.where("l_shipdate >= timestamp'1995-01-01'").withColumn("l_quantity", F.expr("l_quantity + 1"))
    for at, report in ((AT, lines.where("l_shipdate < timestamp'1997-01-01'")), (LATER, restated)):
        _land(spark, report, f"{root}/landing", at.strftime("%Y%m%d_%H%M%S"))
        ingest(spark, f"{root}/landing", f"{root}/bronze", at=at).complete()
        refine(spark, f"{root}/bronze", f"{root}/silver", at).complete()
    return aggregate.summarize(latest_silver(spark, f"{root}/silver"), "daily_summary")


def landed_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of reports with two records each, and a field that no schema knows."""
    root = scratch_path(spark, "extra")
    lines = derive.lineitem(spark, sf_dir).withColumn("extra_order", F.col("l_orderkey"))
    _land(spark, lines, f"{root}/landing", "20260312_090000", ("struct(*, 1 AS copy)", "struct(*, 2 AS copy)"))
    ingest(spark, f"{root}/landing", f"{root}/bronze", at=AT).complete()
    frames = []
    for name, spec in SOURCES.items():
        bronze = read_snapshot(spark, latest_snapshot(spark, f"{root}/bronze", name))
        extra = [f"cast(get_json_object(_record, '$.{f}') AS bigint) AS {f}" for f in ("extra_order", "copy")]
        own = [f"`{spec.columns[c]}` AS {c}" for c in ("campaign_name", "ad_group_name", "impressions", "clicks")]
        frames.append(bronze.selectExpr("_source", "_ingested_at", *own, *extra, "array_contains(_fields, 'copy') AS has_copy"))
    return union_strict(frames)


def run_log_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of a refine stage; path and duration differ from run to run."""
    root = scratch_path(spark, "logged")
    results = refine(spark, _bronze(spark, sf_dir, root), f"{root}/silver", LATER).complete()
    append_run(spark, f"{root}/run_log", "refine", results, 0.0, LATER)
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(f"{root}/run_log").drop("path", "duration_seconds")


def _gold_root(spark: SparkSession, sf_dir: str, root: str) -> str:
    lines = derive.lineitem(spark, sf_dir)

    def write(name: str) -> Written:
        raw = derive.raw_report(derive.own_lines(lines, name), SOURCES[name])
        rows = normalize(raw, SOURCES[name], f"{name}.parquet", AT)
        return write_snapshot(rows, f"{root}/silver", name, AT)

    each(spark, "silver", SOURCES, write).complete()
    summarize_all(spark, f"{root}/silver", f"{root}/gold", AT).complete()
    return f"{root}/gold"


def daily_sevenths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs that no decimal can hold, summed exactly."""
    silver = _silver(spark, sf_dir).withColumn("cost_brl", F.expr("cost_brl / 7D"))
    return aggregate.daily_summary(silver)


def served_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals in the served types as declared, decimals as decimals."""
    silver = _silver(spark, sf_dir).withColumn("cost_brl", F.expr("cost_brl / 1000D"))
    return merge.as_served(aggregate.summarize(silver, "daily_summary"), "daily_summary")


def gold_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each row in the sorted gold tables, whose sizes the calendar, the platforms and their campaigns bound."""
    silver, place = _silver(spark, sf_dir), F.row_number().over(Window.orderBy("id")).cast("long")
    frames = []
    for table in (aggregate.daily_summary, aggregate.campaign_summary, aggregate.source_comparison):
        rows = table(silver).withColumn("id", F.monotonically_increasing_id()).selectExpr(*_head(table.__name__), "id")
        frames.append(rows.withColumn("place", place).drop("id"))
    return union_strict(frames)


def checked_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality run over damaged silver snapshots, and what the gate says of each platform."""
    root, damaged = scratch_path(spark, "checked"), _damaged(spark, sf_dir)

    def write(name: str) -> Written:
        rows = damaged.where(F.col("source_dir") == name).drop("source_dir")
        return write_snapshot(rows, f"{root}/silver", name, AT)

    each(spark, "silver", SOURCES, write).complete()
    summary = quality.quality_summary(reports_by_source(check(spark, f"{root}/silver").complete()))
    stopped = quality.gate(summary, "warn")
    return summary.withColumn("stopped", F.col("source_file").isin(stopped))


def _faulty_bronze(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Bronze with values that cannot be read and rows that break the contract, each on one platform."""
    lines = derive.lineitem(spark, sf_dir)
    faults = {
        "google_ads": {"impressions": "CASE impressions WHEN 4500 THEN -1L ELSE impressions END"},
        "meta_ads": {"campaign_name": "CASE reach WHEN 4600 THEN '' WHEN 4700 THEN NULL ELSE campaign_name END"},
        "tiktok_ads": {
            "total_cost": "CASE WHEN views IN (4800, 4900) THEN 'n/a' ELSE total_cost END",
            "stat_time": "CASE WHEN views IN (4900, 5000) THEN 'yesterday' ELSE stat_time END",
        },
    }

    def write(name: str) -> Written:
        raw = derive.raw_report(derive.own_lines(lines, name), SOURCES[name])
        raw = raw.withColumns({c: F.expr(e) for c, e in faults[name].items()})
        return write_snapshot(with_ingest_columns(raw, SOURCES[name], AT.date()), f"{root}/bronze", name, AT)

    each(spark, "bronze", SOURCES, write).complete()
    return f"{root}/bronze"


def refined_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and both kinds of quarantine from one pass over bronze; all rows with where they went."""
    root = scratch_path(spark, "once")
    refine_once(spark, _faulty_bronze(spark, sf_dir, root), f"{root}/silver", AT, f"{root}/aside", True, True).complete()
    frames = []
    for name in KNOWN_SOURCES:
        for why, at in (("valid", f"{root}/silver"), ("contract", f"{root}/aside/contract"), ("unparsed", f"{root}/aside/unparsed")):
            path = latest_snapshot(spark, at, name)
            if path is not None:
                rows = read_snapshot(spark, path)
                unparsed = "unparsed" if "unparsed" in rows.columns else "''"
                frames.append(rows.selectExpr(f"'{why}' AS went_to", f"cast({unparsed} AS string) AS unparsed", *SILVER_SCHEMA.names[:8]))
    return union_strict(frames)


def checked_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality reports of silver from the counters kept when it was written."""
    root = scratch_path(spark, "kept")
    bronze = _faulty_bronze(spark, sf_dir, root)
    refine_once(spark, bronze, f"{root}/silver", AT, lenient=True).complete()
    return reports_by_source(check_kept(spark, f"{root}/silver").complete())


def written_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness and size of the files that a run has just written, by dataset; sizes next to what the files hold."""
    root = scratch_path(spark, "health")
    refine(spark, _bronze(spark, sf_dir, root), f"{root}/silver", LATER).complete()
    summarize_all(spark, f"{root}/silver", f"{root}/gold", LATER).complete()
    health = dataset_health(spark, root).select("layer", "dataset", "ok")
    sizes = layer_files(spark, root).groupBy("layer", "dataset").agg(F.sum("bytes").alias("bytes"))
    held = _held_bytes(spark, root)
    return health.join(sizes, ["layer", "dataset"]).join(held, ["layer", "dataset"]).selectExpr("layer", "dataset", "ok", "bytes = held AND bytes > 0 AS has_size")


def _held_bytes(spark: SparkSession, root: str) -> DataFrame:
    """(layer, dataset, held): the bytes of the files in the latest folder of each dataset, read byte by byte."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    folder = "split(path, '/')"
    held = files.selectExpr(f"element_at({folder}, -4) AS layer", f"element_at({folder}, -3) AS dataset", f"element_at({folder}, -2) AS run", "octet_length(content) AS held")
    return held.groupBy("layer", "dataset", "run").agg(F.sum("held").alias("held")).groupBy("layer", "dataset").agg(F.max_by("held", "run").alias("held"))


def committed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, freshness and size of what a run has written, from the markers of the snapshots alone."""
    root = scratch_path(spark, "sizes")
    refine(spark, _bronze(spark, sf_dir, root), f"{root}/silver", LATER).complete()
    summarize_all(spark, f"{root}/silver", f"{root}/gold", LATER).complete()
    health = committed_health(spark, root).join(_held_bytes(spark, root), ["layer", "dataset"])
    return health.selectExpr("layer", "dataset", "ok", "rows", "bytes = held AS exact_bytes", "files > 0 AS has_files")


def clustered_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of dates over a snapshot that is clustered by date, so most of its row groups are skipped."""
    root = scratch_path(spark, "clustered")
    path = write_snapshot(_silver(spark, sf_dir), root, "all", AT, cluster_by="date").path
    return date_window(read_snapshot(spark, path, SILVER_SCHEMA), date(1998, 1, 1), date(1998, 3, 31))


def _drifting(spark: SparkSession, sf_dir: str, more: tuple[str, ...] = ()) -> str:
    """All of lineitem in one snapshot that three writers have filled, each with its own idea of the types."""
    path = f"{scratch_path(spark, 'drift')}/lines/snapshot=20260312_100000"
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = "l_orderkey", "l_linenumber", "l_returnflag", "cast(l_shipdate AS date) AS l_shipdate"
    old = "cast(l_quantity AS int) AS l_quantity", "cast(l_linenumber AS decimal(6,2)) AS weight"
    new = "l_quantity", "l_extendedprice", "l_tax", "cast(l_suppkey AS decimal(20,0)) AS weight"
    writers = {
        "A": ["cast(l_orderkey AS int) AS l_orderkey", "cast(l_linenumber AS short) AS l_linenumber", *key[2:], *old, *more],
        "N": [*key[:3], "cast(l_shipdate AS timestamp_ntz) AS l_shipdate", *new],
        "R": [*key, *new, "l_linestatus"],
    }
    for flag, columns in writers.items():
        lines.where(F.col("l_returnflag") == flag).selectExpr(*columns).write.mode("append").parquet(path)
    return path


def drifting_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the snapshot, in the one schema that holds every file."""
    return read_snapshot(spark, _drifting(spark, sf_dir))


def drifting_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the footers of the snapshot say of each column, two of which differ in case only."""
    path = _drifting(spark, sf_dir, ("cast(l_tax AS string) AS L_TAX",))
    report = drift_report(spark, path)
    return report.selectExpr("name", "types", "lacking > 0 AS lacking", "verdict")


def _all_gold(spark: SparkSession, gold: str) -> DataFrame:
    """The rows of the three latest gold snapshots."""
    frames = []
    for name in GOLD_TABLES:
        rows = spark.read.parquet(latest_snapshot(spark, gold, name))
        frames.append(rows.selectExpr(*_head(name), *METRICS, *RATIOS))
    return union_strict(frames)


def _head(table: str) -> list[str]:
    day, campaign = (c if c in GOLD_TABLES[table].keys else "NULL" for c in ("date", "campaign_name"))
    return [f"'{table}' AS gold_table", f"cast({day} AS string) AS day", f"cast({campaign} AS string) AS campaign_name", "source"]


def gold_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver snapshots -> the three gold snapshots, rolled up from one scan; all rows."""
    return _all_gold(spark, _gold_root(spark, sf_dir, scratch_path(spark, "gold")))


def restated_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of all days, then of 25 restated days, summed from these days and the totals that were kept."""
    root, lines = scratch_path(spark, "restated"), derive.lineitem(spark, sf_dir)
    for at, reported in ((AT, lines), (LATER, _restated_days(lines))):

        def write(name: str, reported: DataFrame = reported, at: datetime = at) -> Written:
            raw = derive.raw_report(derive.own_lines(reported, name), SOURCES[name])
            return write_snapshot(normalize(raw, SOURCES[name], f"{name}.parquet", at), f"{root}/silver", name, at)

        each(spark, "silver", SOURCES, write).complete()
        summarize_restated(spark, f"{root}/silver", f"{root}/totals", f"{root}/gold", at).complete()
    return _all_gold(spark, f"{root}/gold")


def served_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold snapshots loaded twice into the served tables; all three as served."""
    root = scratch_path(spark, "served")
    gold = _gold_root(spark, sf_dir, root)
    for at in (AT, LATER):
        serve_all(spark, gold, f"{root}/served", at, WIDE).complete()
    return _all_served(lambda table: served(spark, f"{root}/served", table, WIDE))


def _all_served(table: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of the three served tables."""
    return union_strict([_as_text(table(t)).selectExpr(*_head(t), *METRICS, *RATIOS, "loaded_at") for t in GOLD_TABLES])


def _restated_days(lines: DataFrame) -> DataFrame:
    """Other metrics for 25 days, which is 1 % of the days."""
    days = lines.where("l_shipdate >= timestamp_ntz'1998-03-01' AND l_shipdate < timestamp_ntz'1998-03-26'")
    return days.withColumn("l_quantity", F.expr("l_quantity + 1"))


def _write_gold(spark: SparkSession, lines: DataFrame, root: str, at: datetime) -> None:
    silver = normalize_mixed(derive.raw_mixed(lines), "lineitem", at)
    each(spark, "gold", GOLD_TABLES, lambda t: write_snapshot(aggregate.summarize(silver, t), root, t, at)).complete()


def served_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gold in one commit, then that of 25 restated days; the three tables of one version."""
    root, lines = scratch_path(spark, "together"), derive.lineitem(spark, sf_dir)
    for at, reported in ((AT, lines), (LATER, _restated_days(lines))):
        _write_gold(spark, reported, f"{root}/gold", at)
        serve_together(spark, f"{root}/gold", f"{root}/served", at, WIDE)
    version = read_manifest(spark, f"{root}/served")
    return _all_served(lambda table: served_version(spark, f"{root}/served", table, WIDE, version))


def _gold(builder: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: builder(_silver(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "silver_google": _normalized("google_ads"),
    "silver_meta": _normalized("meta_ads"),
    "silver_tiktok": _normalized("tiktok_ads"),
    "silver_mixed": _silver,
    "silver_union": silver_union,
    "silver_lenient": silver_lenient,
    "daily_summary": _gold(aggregate.daily_summary),
    "campaign_summary": _gold(aggregate.campaign_summary),
    "source_comparison": _gold(aggregate.source_comparison),
    "derived_metrics_zero": derived_metrics_zero,
    "row_contract_valid": row_contract_valid,
    "row_contract_quarantine": row_contract_quarantine,
    "quality_report": quality_report,
    "quality_failures": quality_failures,
    "quality_by_source": _quality_by_source,
    "quality_summary": quality_summary,
    "quality_missing_columns": quality_missing_columns,
    "served_types": served_types,
    "upsert_merge": upsert_merge,
    "latest_snapshot": latest_snapshot_rows,
    "date_window": date_window_rows,
    "date_spine": date_spine,
    "date_spine_gaps": date_spine_gaps,
    "lenient_date": lenient_dates,
    "envelope_unnest": envelope_unnest,
    "distinct_sources": distinct_sources,
    "freshness": layer_freshness,
    "freshness_newest": layer_freshness_newest,
    "overall_health": overall_health,
    "file_sizes": file_sizes,
    "landed_snapshots": landed_snapshots,
    "refined_snapshots": refined_snapshots,
    "run_log_snapshots": run_log_snapshots,
    "gold_snapshots": gold_snapshots,
    "served_snapshots": served_snapshots,
    "restated_gold": restated_gold,
    "served_together": served_together,
    "landed_documents": landed_documents,
    "overlapping_landings": overlapping_landings,
    "landed_extra_fields": landed_extra_fields,
    "daily_sevenths": daily_sevenths,
    "served_defaults": served_defaults,
    "gold_order": gold_order,
    "refined_once": refined_once,
    "checked_once": checked_once,
    "checked_snapshots": checked_snapshots,
    "written_health": written_health,
    "committed_sizes": committed_sizes,
    "clustered_window": clustered_window,
    "drifting_snapshot": drifting_snapshot,
    "drifting_columns": drifting_columns,
}
