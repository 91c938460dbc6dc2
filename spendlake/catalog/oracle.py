"""The same results in plain SQL, written against the given tables."""

from __future__ import annotations

_LINES = """lines AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CASE l_returnflag WHEN 'A' THEN 'google_ads' WHEN 'N' THEN 'meta_ads' ELSE 'tiktok_ads' END AS source,
         'Campaign ' || l_linestatus || CAST(l_linenumber AS VARCHAR) AS campaign_name,
         'Group ' || CAST(l_suppkey AS VARCHAR) AS ad_group_name,
         CAST(floor(l_quantity) AS BIGINT) * 100 AS impressions,
         CAST(floor(l_quantity * l_discount * 100) AS BIGINT) AS clicks,
         l_extendedprice AS cost_brl,
         CAST(trunc(l_quantity * l_discount * l_tax * 100) AS BIGINT) AS conversions
  FROM lineitem)"""

_SILVER = "date, source, campaign_name, ad_group_name, impressions, clicks, cost_brl, conversions"


def _rounded(value: str, digits: int = 4) -> str:
    """Ties to even, on the scaled double."""
    y = f"({value} * 1e{digits})"
    tie = f"{y} - floor({y}) = 0.5"
    return f"CASE WHEN {tie} THEN 2 * floor((floor({y}) + 1) / 2) ELSE floor({y} + 0.5) END / 1e{digits}"


def _ratio(numerator: str, denominator: str, factor: str = "") -> str:
    value = f"(CAST({numerator} AS DOUBLE) / {denominator}{factor})"
    return f"CASE WHEN {denominator} > 0 THEN {_rounded(value)} ELSE CAST(0 AS DOUBLE) END"


_RATIOS = f"""{_ratio('clicks', 'impressions', ' * CAST(100 AS DOUBLE)')} AS ctr_pct,
       {_ratio('cost_brl', 'clicks')} AS cpc_brl,
       {_ratio('cost_brl', 'impressions', ' * CAST(1000 AS DOUBLE)')} AS cpm_brl,
       {_ratio('cost_brl', 'conversions')} AS cpa_brl"""


# The sum of the doubles as they are, in whole units of 2^-56, read back from its digits.
_EXACT_COST = """CAST(CAST(sum(CAST(cost_brl * 72057594037927936 AS HUGEINT)) AS VARCHAR) AS DOUBLE)
           / 72057594037927936"""


def _totals(keys: str, rows: str = "lines") -> str:
    return f"""SELECT {keys},
         CAST(sum(impressions) AS BIGINT) AS impressions,
         CAST(sum(clicks) AS BIGINT) AS clicks,
         {_EXACT_COST} AS cost_brl,
         CAST(sum(conversions) AS BIGINT) AS conversions
  FROM {rows} GROUP BY {keys}"""


def _gold(keys: str, order: str) -> str:
    return f"""WITH {_LINES},
totals AS ({_totals(keys)})
SELECT {keys}, impressions, clicks, cost_brl, conversions,
       {_RATIOS}
FROM totals ORDER BY {order}"""


def _one_platform(name: str) -> str:
    return f"""WITH {_LINES}
SELECT date, '{name}' AS source, campaign_name, ad_group_name, impressions, clicks, cost_brl, conversions,
       'lineitem' AS source_file, '2026-03-12T10:00:00' AS transformed_at
FROM lines"""


_DAMAGED = """damaged AS (
  SELECT CASE WHEN l_shipdate >= TIMESTAMP '1995-02-01' THEN CAST(l_shipdate AS DATE) END AS date,
         CASE WHEN l_discount = 0 AND l_tax = 0 THEN 'unknown_platform'
              WHEN l_linestatus = 'O' THEN '  ' || upper(platform[1:1]) || platform[2:] || chr(9)
              ELSE platform END AS source,
         CASE WHEN l_linenumber <> 7 THEN 'Campaign ' || l_linestatus || CAST(l_linenumber AS VARCHAR) END
           AS campaign_name,
         CASE WHEN l_quantity = 46 THEN '' ELSE 'Group ' || CAST(l_suppkey AS VARCHAR) END AS ad_group_name,
         CASE WHEN l_quantity = 45 THEN -1 WHEN l_quantity <> 44 THEN imps END AS impressions,
         CASE WHEN l_quantity = 50 THEN imps + 1 WHEN l_quantity <> 44 THEN clks END AS clicks,
         CASE WHEN l_extendedprice < 2000 THEN -l_extendedprice ELSE l_extendedprice / 7 END AS cost_brl,
         CASE WHEN l_quantity = 49 THEN clks + 1 WHEN l_quantity = 48 THEN -1 ELSE convs END AS conversions,
         platform || '/lineitem.parquet' AS source_file,
         '2026-03-12T10:00:00' AS transformed_at,
         platform AS source_dir
  FROM (SELECT *,
               CASE l_returnflag WHEN 'A' THEN 'google_ads' WHEN 'N' THEN 'meta_ads' ELSE 'tiktok_ads' END
                 AS platform,
               CAST(floor(l_quantity) AS BIGINT) * 100 AS imps,
               CAST(floor(l_quantity * l_discount * 100) AS BIGINT) AS clks,
               CAST(floor(l_quantity * l_discount * l_tax * 100) AS BIGINT) AS convs
        FROM lineitem))"""

_CLEAN_SOURCE = "lower(trim(source, ' ' || chr(9)))"
_FITS = f"""coalesce(date IS NOT NULL
  AND length(source) >= 1 AND length(campaign_name) >= 1 AND length(ad_group_name) >= 1
  AND length(source_file) >= 1 AND length(transformed_at) >= 1
  AND impressions >= 0 AND clicks >= 0 AND conversions >= 0 AND cost_brl >= 0
  AND {_CLEAN_SOURCE} IN ('google_ads', 'meta_ads', 'tiktok_ads'), false)"""

_KNOWN = "('google_ads', 'meta_ads', 'tiktok_ads')"
_NULL_CHECKED = [
    "date",
    "source",
    "campaign_name",
    "ad_group_name",
    "impressions",
    "clicks",
    "cost_brl",
    "conversions",
    "source_file",
    "transformed_at",
]


def _rules() -> list[tuple[str, str, str, str, str]]:
    """(type, column, description, violated, considered) of rules 2 to 18."""
    rules = [
        ("expect_column_values_to_not_be_null", c, f"{c} is never null", f"{c} IS NULL", "true")
        for c in _NULL_CHECKED
    ]
    rules.append(
        (
            "expect_column_values_to_be_in_set",
            "source",
            "source is a known platform",
            f"source NOT IN {_KNOWN}",
            "source IS NOT NULL",
        )
    )
    rules += [
        ("expect_column_values_to_be_between", c, f"{c} is at least 0", f"{c} < 0", f"{c} IS NOT NULL")
        for c in ("impressions", "clicks", "conversions", "cost_brl")
    ]
    rules += [
        (
            "expect_column_pair_values_a_to_be_greater_than_b",
            a,
            f"{a} are at least {b}",
            f"NOT ({a} IS NULL AND {b} IS NULL) AND NOT coalesce({a} >= {b}, false)",
            f"NOT ({a} IS NULL AND {b} IS NULL)",
        )
        for a, b in (("impressions", "clicks"), ("clicks", "conversions"))
    ]
    return rules


def _report(file: str, group: str = "", missing: tuple[str, ...] = ()) -> str:
    """One SELECT per rule; rules on missing columns fail without counts."""
    present = f"{file} AS source_file"
    constants = f"FROM damaged {group}" if group else ""
    parts = [
        f"""SELECT {present}, 1 AS rule, 'expect_table_columns_to_match_set' AS expectation_type,
       CAST(NULL AS VARCHAR) AS "column", 'all silver columns are present' AS description,
       {'false' if missing else 'true'} AS success, CAST(NULL AS BIGINT) AS unexpected_count,
       CAST(NULL AS DOUBLE) AS unexpected_percent
{constants}"""
    ]
    for i, (kind, column, text, bad, seen) in enumerate(_rules(), start=2):
        head = f"SELECT {present}, {i}, '{kind}', '{column}', '{text}',"
        if any(m in f"{column} {bad}".split() for m in missing):
            parts.append(f"{head} false, NULL, NULL {constants}")
            continue
        count = f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT)"
        of = f"count(*) FILTER (WHERE {seen})"
        parts.append(
            f"{head} {count} = 0, {count}, "
            f"CASE WHEN {of} > 0 THEN CAST({count} AS DOUBLE) / {of} * 100 END FROM damaged {group}"
        )
    return "\nUNION ALL\n".join(parts)


_BY_SOURCE = f"WITH {_DAMAGED}\n{_report('source_dir', 'GROUP BY source_dir')}"


def _daily(name: str, where: str) -> str:
    return f"""{name}_totals AS ({_totals('date, source', f'(SELECT * FROM lines WHERE {where})')}),
{name} AS (SELECT *, {_RATIOS} FROM {name}_totals)"""


_MONEY = "CAST(CAST({c} AS DECIMAL(28, 6)) AS VARCHAR) AS {c}"
_RATIO = "CAST(CAST({c} AS DECIMAL(20, 4)) AS VARCHAR) AS {c}"


def _served(keys: str, impressions: str = "impressions") -> str:
    ratios = ", ".join(_RATIO.format(c=c) for c in ("ctr_pct", "cpc_brl", "cpm_brl", "cpa_brl"))
    return f"{keys}, {impressions} AS impressions, clicks, {_MONEY.format(c='cost_brl')}, conversions, {ratios}"


_FILES = """files AS (
  SELECT event_type AS layer,
         event_type || printf('/u%06d/part-%010d.parquet', user_id, event_id) AS path,
         ts AS modified_at
  FROM events)"""


def _freshness(order: str) -> str:
    return f"""latest AS (
  SELECT layer, path, modified_at,
         row_number() OVER (PARTITION BY layer ORDER BY {order}) AS place
  FROM files),
aged AS (
  SELECT layer, regexp_extract(path, '([^/]+)$', 1) AS latest_file,
         {_rounded("(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(modified_at)) / 3600e6", 1)}
           AS age_hours
  FROM latest WHERE place = 1),
status AS (
  SELECT layer, latest_file, age_hours, age_hours <= 25 AS ok,
         CASE WHEN age_hours > 25 THEN 'latest file is ' || CAST(age_hours AS VARCHAR) || 'h old' ELSE 'ok' END
           AS message
  FROM aged)"""


# Keys of the gold tables, and their day and campaign as text.
_SERVED_KEYS = {
    "daily_summary": ("date, source", "CAST(date AS VARCHAR)", "NULL"),
    "campaign_summary": ("source, campaign_name", "NULL", "campaign_name"),
    "source_comparison": ("source", "NULL", "NULL"),
}
_RESTATED = _LINES.replace("lines AS", "restated AS").replace(
    "FROM lineitem)",
    """FROM (SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-03-26'))""",
)


def _named(table: str) -> str:
    _, day, campaign = _SERVED_KEYS[table]
    return f"'{table}' AS gold_table, {day} AS day, {campaign} AS campaign_name, source"


def _totals_of(name: str, rows: str) -> str:
    """The three gold tables, named ``name`` and the table."""
    parts = []
    for table, (keys, _, _) in _SERVED_KEYS.items():
        parts.append(f"{name}_{table}_totals AS ({_totals(keys, rows)})")
        parts.append(f"{name}_{table} AS (SELECT *, {_RATIOS} FROM {name}_{table}_totals)")
    return ",\n".join(parts)


def _all_gold(rows: str) -> str:
    values = "impressions, clicks, cost_brl, conversions, ctr_pct, cpc_brl, cpm_brl, cpa_brl"
    return _totals_of("all", rows) + "\n" + "\nUNION ALL\n".join(f"SELECT {_named(t)}, {values} FROM all_{t}" for t in _SERVED_KEYS)


def _after_restating(table: str) -> str:
    """A served table: the rows of the restated days, and of all others the rows with other keys."""
    same = " AND ".join(f"restated_{table}.{k} = all_{table}.{k}" for k in _SERVED_KEYS[table][0].split(", "))
    first, second = "TIMESTAMP '2026-03-12 10:00:00'", "TIMESTAMP '2026-03-13 10:00:00'"
    return f"""SELECT {_served(_named(table))}, {first} AS loaded_at FROM all_{table}
WHERE NOT EXISTS (SELECT 1 FROM restated_{table} WHERE {same})
UNION ALL
SELECT {_served(_named(table))}, CASE WHEN EXISTS (SELECT 1 FROM all_{table} WHERE {same}) THEN {first} ELSE {second} END
FROM restated_{table}"""


_FAULTY = f"""{_LINES},
faulty AS (
  SELECT date, source,
         CASE WHEN source = 'meta_ads' AND impressions = 4600 THEN ''
              WHEN source <> 'meta_ads' OR impressions <> 4700 THEN campaign_name END AS campaign_name,
         ad_group_name, CASE WHEN source = 'google_ads' AND impressions = 4500 THEN -1 ELSE impressions END AS impressions,
         clicks, cost_brl, conversions, source || '/x' AS source_file, '2026-03-12T10:00:00' AS transformed_at, source AS source_dir,
         CASE WHEN source <> 'tiktok_ads' OR impressions < 4800 THEN '' WHEN impressions = 4800 THEN 'cost_brl'
              WHEN impressions = 4900 THEN 'date,cost_brl' ELSE 'date' END AS unparsed
  FROM lines),
damaged AS (SELECT * FROM faulty WHERE unparsed = '')"""


ORACLE_SQL: dict[str, str] = {
    "silver_google": _one_platform("google_ads"),
    "silver_meta": _one_platform("meta_ads"),
    "silver_tiktok": _one_platform("tiktok_ads"),
    "silver_mixed": f"""WITH {_LINES}
SELECT {_SILVER}, 'lineitem' AS source_file, '2026-03-12T10:00:00' AS transformed_at FROM lines""",
    "silver_union": f"""WITH {_LINES}
SELECT {_SILVER}, source || '.parquet' AS source_file, '2026-03-12T10:00:00' AS transformed_at FROM lines""",
    "silver_lenient": f"""WITH {_LINES}
SELECT CASE WHEN impressions NOT IN (4600, 5000) THEN date END AS date, 'tiktok_ads' AS source, campaign_name, ad_group_name,
       impressions, clicks,
       CASE WHEN impressions NOT IN (4000, 4100, 4200, 4300, 4400, 4500, 4700, 4800, 4900, 5000) THEN cost_brl END AS cost_brl, conversions,
       'lineitem' AS source_file, '2026-03-12T10:00:00' AS transformed_at,
       CASE WHEN impressions = 5000 THEN 'date,cost_brl' WHEN impressions = 4600 THEN 'date'
            WHEN impressions >= 4000 THEN 'cost_brl' ELSE '' END AS unparsed
FROM lines""",
    "daily_summary": _gold("date, source", "date, source"),
    "campaign_summary": _gold("source, campaign_name", "source, campaign_name"),
    "source_comparison": _gold("source", "cost_brl DESC"),
    "derived_metrics_zero": f"""WITH {_LINES}
SELECT {_SILVER},
       {_RATIOS}
FROM lines""",
    "row_contract_valid": f"""WITH {_DAMAGED}
SELECT date, {_CLEAN_SOURCE} AS source, campaign_name, ad_group_name, impressions, clicks,
       {_rounded('cost_brl', 6)} AS cost_brl, conversions, source_file, transformed_at, source_dir
FROM damaged WHERE {_FITS}""",
    "row_contract_quarantine": f"""WITH {_DAMAGED}
SELECT {_SILVER}, source_file, transformed_at, source_dir FROM damaged WHERE NOT {_FITS}""",
    "quality_report": f"WITH {_DAMAGED}\n{_report(chr(39) + 'lineitem' + chr(39))}",
    "quality_failures": f"""WITH {_DAMAGED}
SELECT source_file, expectation_type, "column", description, unexpected_count, unexpected_percent
FROM ({_report(chr(39) + 'lineitem' + chr(39))}) AS report WHERE NOT success""",
    "quality_by_source": _BY_SOURCE,
    "quality_summary": f"""WITH {_DAMAGED},
report AS ({_report('source_dir', 'GROUP BY source_dir')}),
summary AS (
  SELECT source_file, bool_and(success) AS success, count(rule) AS total_expectations,
         count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed
  FROM report GROUP BY source_file)
SELECT known.source_file, success, total_expectations, passed, failed
FROM (VALUES ('google_ads'), ('meta_ads'), ('tiktok_ads'), ('another_source')) AS known(source_file)
LEFT JOIN summary USING (source_file)""",
    "quality_missing_columns": f"""WITH {_DAMAGED}
{_report(chr(39) + 'lineitem' + chr(39), missing=('clicks', 'source_file'))}""",
    "served_types": f"""WITH {_LINES},
{_daily('gold', 'true')}
SELECT {_served('date, source')} FROM gold""",
    "upsert_merge": f"""WITH {_LINES},
{_daily('stored', "date < DATE '1998-07-01'")},
{_daily('batch', "date >= DATE '1998-01-01'")}
SELECT {_served('date, source', 'impressions * 2')},
       CASE WHEN date < DATE '1998-07-01' THEN TIMESTAMP '2026-03-12 10:00:00'
            ELSE TIMESTAMP '2026-03-13 10:00:00' END AS loaded_at
FROM batch
UNION ALL
SELECT {_served('date, source')}, TIMESTAMP '2026-03-12 10:00:00'
FROM stored WHERE date < DATE '1998-01-01'""",
    "latest_snapshot": "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders",
    "date_window": f"""WITH {_LINES}
SELECT {_SILVER}, 'lineitem' AS source_file, '2026-03-12T10:00:00' AS transformed_at
FROM lines WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'""",
    "date_spine": f"""WITH {_LINES},
spans AS (SELECT source, min(date) AS first, max(date) AS last FROM lines GROUP BY source)
SELECT source, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM spans""",
    "date_spine_gaps": f"""WITH {_LINES},
spans AS (SELECT source, min(date) AS first, max(date) AS last FROM lines GROUP BY source),
spine AS (
  SELECT source, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM spans)
SELECT source, date FROM spine
WHERE NOT EXISTS (SELECT 1 FROM lines WHERE lines.source = spine.source AND lines.date = spine.date)""",
    "lenient_date": """SELECT o_orderkey,
       CASE WHEN o_orderpriority[1:1] IN ('1', '2', '3') THEN CAST(o_orderdate AS DATE)
            ELSE DATE '1990-01-01' END AS day
FROM orders""",
    "envelope_unnest": """SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS campaign_name,
       'User ' || CAST(user_id AS VARCHAR) AS ad_group_name,
       CAST(CAST(props->>'$.k' AS BIGINT) * times AS DOUBLE) AS impressions,
       CAST(CAST(props->>'$.k' AS BIGINT) AS DOUBLE) AS clicks,
       CAST(floor(value * 1e6 + 0.5) AS DOUBLE) AS cost_micros, value AS conversions, 'BRL' AS currency,
       'google_ads' AS _source, '2026-03-12' AS _ingested_at
FROM events, (VALUES (100), (200)) AS copies(times)
WHERE event_type NOT IN ('error', 'signup')""",
    "distinct_sources": f"""WITH {_LINES}
SELECT count(DISTINCT source) + CAST(count(*) > count(source) AS BIGINT) AS sources FROM lines""",
    "freshness": f"""WITH {_FILES},
{_freshness('path DESC')}
SELECT * FROM status""",
    "freshness_newest": f"""WITH {_FILES},
{_freshness('modified_at DESC, path DESC')}
SELECT * FROM status""",
    "overall_health": f"""WITH {_FILES},
{_freshness('modified_at DESC, path DESC')}
SELECT CASE WHEN bool_and(coalesce(ok, false)) THEN 'healthy' ELSE 'degraded' END AS status,
       count(*) FILTER (WHERE ok) AS components_ok, count(*) AS components
FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('silver')) AS expected(layer)
LEFT JOIN status USING (layer)""",
    "file_sizes": f"SELECT {_rounded('CAST(sum(event_id) AS DOUBLE) / 1024', 2)} AS size_kb FROM events",
    "landed_snapshots": f"""WITH {_LINES}
SELECT {_SILVER}, source || '/snapshot=20260312_100000' AS source_file, '2026-03-12T10:00:00' AS transformed_at
FROM lines""",
    "served_together": f"""WITH {_LINES},
{_RESTATED},
{_totals_of("all", "lines")},
{_totals_of("restated", "restated")}
{" UNION ALL ".join(map(_after_restating, _SERVED_KEYS))}""",
    "overlapping_landings": f"""WITH {_LINES.replace("FROM lineitem)", """FROM (
    SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01'))""")},
totals AS ({_totals('date, source')})
SELECT *, {_RATIOS} FROM totals""",
    "landed_extra_fields": f"""WITH {_LINES.replace("SELECT ", "SELECT l_orderkey, ", 1)}
SELECT source AS _source, '2026-03-12' AS _ingested_at, campaign_name, ad_group_name, CAST(impressions AS DOUBLE) AS impressions,
       CAST(clicks AS DOUBLE) AS clicks, CAST(l_orderkey AS BIGINT) AS extra_order, CAST(copy AS BIGINT) AS copy, true AS has_copy
FROM lines, (VALUES (1), (2)) AS copies(copy)""",
    "daily_sevenths": f"""WITH {_LINES},
sevenths AS (SELECT * REPLACE (cost_brl / 7 AS cost_brl) FROM lines),
totals AS ({_totals('date, source', 'sevenths')})
SELECT *, {_RATIOS} FROM totals""",
    "served_defaults": f"""WITH {_LINES},
totals AS ({_totals('date, source', '(SELECT * REPLACE (cost_brl / 1000 AS cost_brl) FROM lines)')}),
gold AS (SELECT *, {_RATIOS} FROM totals)
SELECT date, source, impressions, clicks, CAST(cost_brl AS DECIMAL(14, 6)) AS cost_brl, conversions,
       CAST(ctr_pct AS DECIMAL(10, 4)) AS ctr_pct, CAST(cpc_brl AS DECIMAL(10, 4)) AS cpc_brl,
       CAST(cpm_brl AS DECIMAL(10, 4)) AS cpm_brl, CAST(cpa_brl AS DECIMAL(10, 4)) AS cpa_brl
FROM gold""",
    "gold_order": f"""WITH {_LINES}
SELECT 'daily_summary' AS gold_table, CAST(date AS VARCHAR) AS day, NULL AS campaign_name, source,
       row_number() OVER (ORDER BY date, source) AS place
FROM (SELECT DISTINCT date, source FROM lines)
UNION ALL
SELECT 'campaign_summary', NULL, campaign_name, source, row_number() OVER (ORDER BY source, campaign_name)
FROM (SELECT DISTINCT source, campaign_name FROM lines)
UNION ALL
SELECT 'source_comparison', NULL, NULL, source, row_number() OVER (ORDER BY cost DESC)
FROM (SELECT source, sum(cost_brl) AS cost FROM lines GROUP BY source)""",
    "checked_snapshots": f"""WITH {_DAMAGED},
report AS ({_report('source_dir', 'GROUP BY source_dir')})
SELECT source_file, bool_and(success) AS success, count(rule) AS total_expectations,
       count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed,
       NOT bool_and(success) AS stopped
FROM report GROUP BY source_file""",
    "written_health": f"""WITH {_LINES}
SELECT layer, source AS dataset, true AS ok, true AS has_size
FROM (SELECT DISTINCT source FROM lines), (VALUES ('bronze'), ('silver')) AS layers(layer)
UNION ALL
SELECT 'gold', dataset, true, true
FROM (VALUES ('daily_summary'), ('campaign_summary'), ('source_comparison')) AS gold(dataset)""",
    "run_log_snapshots": f"""WITH {_LINES}
SELECT TIMESTAMP '2026-03-13 10:00:00' AS run_at, 'refine' AS stage, source AS item, 'ok' AS status,
       count(*) AS rows, CAST(3 AS BIGINT) AS items_ok, CAST(0 AS BIGINT) AS items_failed, (SELECT count(*) FROM lines) AS rows_total,
       CAST(NULL AS VARCHAR) AS error
FROM lines GROUP BY source""",
    "refined_snapshots": f"""WITH {_LINES}
SELECT {_SILVER}, source || '/snapshot=20260313_100000' AS source_file, '2026-03-13T10:00:00' AS transformed_at
FROM lines""",
    "gold_snapshots": f"""WITH {_LINES},
{_all_gold("lines")}""",
    "served_snapshots": f"""WITH {_LINES},
{_totals_of("all", "lines")}
{" UNION ALL ".join(f"SELECT {_served(_named(t))}, TIMESTAMP '2026-03-12 10:00:00' AS loaded_at FROM all_{t}" for t in _SERVED_KEYS)}""",
    "restated_gold": f"""WITH {_LINES},
{_RESTATED},
both_reports AS (
  SELECT * FROM lines WHERE date NOT BETWEEN DATE '1998-03-01' AND DATE '1998-03-25' UNION ALL SELECT * FROM restated),
{_all_gold("both_reports")}""",
}
ORACLE_SQL["refined_once"] = f"""WITH {_FAULTY}
SELECT 'unparsed' AS went_to, unparsed, CASE WHEN unparsed NOT LIKE 'date%' THEN date END AS date, source, campaign_name, ad_group_name,
       impressions, clicks, CASE WHEN unparsed NOT LIKE '%cost_brl' THEN cost_brl END AS cost_brl, conversions
FROM faulty WHERE unparsed <> ''
UNION ALL
SELECT CASE WHEN {_FITS} THEN 'valid' ELSE 'contract' END, '', date, source, campaign_name, ad_group_name, impressions, clicks,
       CASE WHEN {_FITS} THEN {_rounded('cost_brl', 6)} ELSE cost_brl END, conversions
FROM damaged"""
ORACLE_SQL["checked_once"] = f"""WITH {_FAULTY}
{_report('source_dir', 'GROUP BY source_dir')}"""
ORACLE_SQL["committed_sizes"] = f"""WITH {_LINES}
SELECT layer, source AS dataset, true AS ok, count(*) AS rows, true AS exact_bytes, true AS has_files
FROM lines, (VALUES ('bronze'), ('silver')) AS layers(layer) GROUP BY layer, source
UNION ALL
SELECT 'gold', 'daily_summary', true, count(DISTINCT (date, source)), true, true FROM lines
UNION ALL
SELECT 'gold', 'campaign_summary', true, count(DISTINCT (source, campaign_name)), true, true FROM lines
UNION ALL
SELECT 'gold', 'source_comparison', true, count(DISTINCT source), true, true FROM lines"""
ORACLE_SQL["clustered_window"] = ORACLE_SQL["date_window"]
ORACLE_SQL["landed_documents"] = ORACLE_SQL["landed_snapshots"]
ORACLE_SQL["drifting_snapshot"] = """
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_returnflag,
       CASE WHEN l_returnflag = 'N' THEN CAST(l_shipdate AS TIMESTAMP) ELSE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS l_shipdate,
       CASE WHEN l_returnflag = 'A' THEN trunc(l_quantity) ELSE l_quantity END AS l_quantity,
       CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS DECIMAL(22,2)) ELSE CAST(l_suppkey AS DECIMAL(22,2)) END AS weight,
       CASE WHEN l_returnflag <> 'A' THEN l_extendedprice END AS l_extendedprice,
       CASE WHEN l_returnflag <> 'A' THEN l_tax END AS l_tax,
       CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS l_linestatus
FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R')"""
ORACLE_SQL["drifting_columns"] = """
WITH files AS (
  SELECT DISTINCT l_returnflag AS flag FROM lineitem),
kinds(flag, name, kind) AS (VALUES
  ('A', 'l_orderkey', 'int'), ('N', 'l_orderkey', 'bigint'), ('R', 'l_orderkey', 'bigint'),
  ('A', 'l_linenumber', 'smallint'), ('N', 'l_linenumber', 'int'), ('R', 'l_linenumber', 'int'),
  ('A', 'l_returnflag', 'string'), ('N', 'l_returnflag', 'string'), ('R', 'l_returnflag', 'string'),
  ('A', 'l_shipdate', 'date'), ('N', 'l_shipdate', 'timestamp_ntz'), ('R', 'l_shipdate', 'date'),
  ('A', 'l_quantity', 'int'), ('N', 'l_quantity', 'double'), ('R', 'l_quantity', 'double'),
  ('A', 'weight', 'decimal(6,2)'), ('N', 'weight', 'decimal(20,0)'), ('R', 'weight', 'decimal(20,0)'),
  ('N', 'l_extendedprice', 'double'), ('R', 'l_extendedprice', 'double'),
  ('N', 'l_tax', 'double'), ('R', 'l_tax', 'double'), ('R', 'l_linestatus', 'string'), ('A', 'L_TAX', 'string'))
SELECT name, string_agg(DISTINCT kind, ', ' ORDER BY kind) AS types,
       count(*) < (SELECT count(*) FROM files) AS lacking,
       CASE WHEN lower(name) = 'l_tax' THEN 'refused'
            WHEN count(DISTINCT kind) = 1 THEN 'same'
            ELSE 'widened to ' || CASE name WHEN 'l_orderkey' THEN 'bigint' WHEN 'l_linenumber' THEN 'int'
              WHEN 'l_shipdate' THEN 'timestamp_ntz' WHEN 'l_quantity' THEN 'double' ELSE 'decimal(22,2)' END
       END AS verdict
FROM kinds JOIN files USING (flag) GROUP BY name"""
