"""Ads data derived from the given tables, in the platforms' raw dialects.

``lineitem`` stands for ad performance: the return flag picks the platform, line
status and line number name the campaign, the supplier names the ad group, and
quantity, discount, tax and price give the metrics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from spendlake.sources.registry import SOURCES, SourceSpec

FLAG_OF = {"google_ads": "A", "meta_ads": "N", "tiktok_ads": "R"}

PLATFORM = "CASE l_returnflag WHEN 'A' THEN 'google_ads' WHEN 'N' THEN 'meta_ads' ELSE 'tiktok_ads' END"
CAMPAIGN = "concat('Campaign ', l_linestatus, l_linenumber)"
AD_GROUP = "concat('Group ', l_suppkey)"
IMPRESSIONS = "floor(l_quantity) * 100"
CLICKS = "floor(l_quantity * l_discount * 100D)"
CONVERSIONS = "l_quantity * l_discount * l_tax * 100D"  # fractional, as the first platform reports them

_RAW = {
    "google_ads": {
        "date": "cast(cast(l_shipdate AS date) AS string)",
        "campaign_name": CAMPAIGN,
        "ad_group_name": AD_GROUP,
        "impressions": IMPRESSIONS,
        "clicks": CLICKS,
        "cost_micros": "floor(l_extendedprice * 1e6D + 0.5D)",
        "conversions": CONVERSIONS,
        "currency": "'BRL'",
    },
    "meta_ads": {
        "date_start": "date_format(l_shipdate, 'dd/MM/yyyy')",
        "date_stop": "date_format(l_shipdate, 'dd/MM/yyyy')",
        "campaign_name": CAMPAIGN,
        "adset_name": AD_GROUP,
        "reach": IMPRESSIONS,
        "link_clicks": CLICKS,
        "spend": "l_extendedprice",
        "results": f"floor({CONVERSIONS})",
        "objective": "'CONVERSIONS'",
        "currency": "'BRL'",
    },
    "tiktok_ads": {
        "stat_time": "cast(l_shipdate AS string)",
        "campaign_title": CAMPAIGN,
        "ad_group_title": AD_GROUP,
        "views": IMPRESSIONS,
        "engagements": CLICKS,
        "total_cost": "cast(l_extendedprice AS string)",
        "conversions_count": f"floor({CONVERSIONS})",
        "campaign_objective": "'TRAFFIC'",
        "country_code": "'BR'",
    },
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def raw_report(lines: DataFrame, spec: SourceSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Every given line as a raw row of one platform, with ``extra`` columns as they are."""
    return lines.selectExpr(*[f"{value} AS {name}" for name, value in _RAW[spec.name].items()], *extra)


def own_lines(lines: DataFrame, name: str) -> DataFrame:
    """The lines that belong to one platform; the filter reaches the Parquet scan."""
    return lines.where(f"l_returnflag = '{FLAG_OF[name]}'")


def raw_mixed(lines: DataFrame) -> DataFrame:
    """Every line as a raw row of its own platform, in one wide frame with ``_source``.

    A column two platforms share holds the value of the row's platform.
    """
    users: dict[str, list[str]] = {}
    for platform in SOURCES:
        for name in _RAW[platform]:
            users.setdefault(name, []).append(platform)
    columns = [f"{PLATFORM} AS _source"]
    for name, platforms in users.items():
        flags = " ".join(f"WHEN '{FLAG_OF[p]}' THEN {_RAW[p][name]}" for p in platforms)
        columns.append(f"CASE l_returnflag {flags} END AS {name}")
    return lines.selectExpr(*columns)


def damaged(lines: DataFrame) -> DataFrame:
    """Silver straight from lineitem, with one kind of damage per quality rule."""
    plain = lines.selectExpr(
        "*",
        f"{PLATFORM} AS platform",
        f"{IMPRESSIONS} AS impressions",
        f"{CLICKS} AS clicks",
        f"floor({CONVERSIONS}) AS conversions",
    )
    return plain.selectExpr(
        "CASE WHEN l_shipdate >= timestamp_ntz'1995-02-01' THEN cast(l_shipdate AS date) END AS date",
        """CASE WHEN l_discount = 0 AND l_tax = 0 THEN 'unknown_platform'
                WHEN l_linestatus = 'O' THEN concat('  ', initcap(platform), '\\t')
                ELSE platform END AS source""",
        f"CASE WHEN l_linenumber <> 7 THEN {CAMPAIGN} END AS campaign_name",
        f"CASE WHEN l_quantity = 46 THEN '' ELSE {AD_GROUP} END AS ad_group_name",
        "CASE l_quantity WHEN 44 THEN NULL WHEN 45 THEN -1L ELSE impressions END AS impressions",
        "CASE l_quantity WHEN 44 THEN NULL WHEN 50 THEN impressions + 1 ELSE clicks END AS clicks",
        """CASE WHEN l_extendedprice < 2000 THEN -l_extendedprice
                ELSE l_extendedprice / 7D END AS cost_brl""",
        "CASE l_quantity WHEN 48 THEN -1L WHEN 49 THEN clicks + 1 ELSE conversions END AS conversions",
        "concat(platform, '/lineitem.parquet') AS source_file",
        "'2026-03-12T10:00:00' AS transformed_at",
        "platform AS source_dir",
    )
