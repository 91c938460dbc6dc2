"""What each platform's raw report looks like. Adding a platform is adding an entry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import types as T

from spendlake.functions.dates import day_month_year, iso_date, iso_timestamp_date


@dataclass(frozen=True)
class SourceSpec:
    """Raw columns of one platform and how they map to silver.

    ``columns`` maps a silver column to its raw column, ``parse_date`` builds the
    SQL that reads the raw date, and ``cost_divisor`` turns the raw cost into BRL. ``envelope_key`` names the array in the JSON report.
    """

    name: str
    envelope_key: str
    raw_schema: T.StructType
    columns: dict[str, str]
    parse_date: Callable[[str], str]
    cost_divisor: int = 1
    envelope_extra: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return list(self.columns.values())

    @property
    def landed_schema(self) -> T.StructType:
        """The raw columns as they are read from JSON: a count may come with a fraction."""
        kinds = [T.DoubleType() if f.dataType == T.LongType() else f.dataType for f in self.raw_schema.fields]
        return T.StructType([T.StructField(f.name, k) for f, k in zip(self.raw_schema.fields, kinds)])

    def envelope_schema(self) -> T.StructType:
        """Schema of the JSON report; its records are kept as text."""
        texts = [T.StructField(c, T.StringType()) for c in ("source", *self.envelope_extra)]
        return T.StructType(
            texts
            + [
                T.StructField("total_rows", T.LongType()),
                T.StructField(self.envelope_key, T.ArrayType(T.StringType())),
            ]
        )


def _schema(**columns: str) -> T.StructType:
    kinds = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


# The platforms' raw field names, envelope keys, date formats and cost units.
SOURCES = {
    spec.name: spec
    for spec in (
        SourceSpec(
            name="google_ads",
            envelope_key="rows",
            raw_schema=_schema(
                date="string",
                campaign_name="string",
                ad_group_name="string",
                impressions="bigint",
                clicks="bigint",
                cost_micros="bigint",
                conversions="double",
                currency="string",
            ),
            columns={
                "date": "date",
                "campaign_name": "campaign_name",
                "ad_group_name": "ad_group_name",
                "impressions": "impressions",
                "clicks": "clicks",
                "cost_brl": "cost_micros",
                "conversions": "conversions",
            },
            parse_date=iso_date,
            cost_divisor=1_000_000,
        ),
        SourceSpec(
            name="meta_ads",
            envelope_key="data",
            raw_schema=_schema(
                date_start="string",
                date_stop="string",
                campaign_name="string",
                adset_name="string",
                reach="bigint",
                link_clicks="bigint",
                spend="double",
                results="bigint",
                objective="string",
                currency="string",
            ),
            columns={
                "date": "date_start",
                "campaign_name": "campaign_name",
                "ad_group_name": "adset_name",
                "impressions": "reach",
                "clicks": "link_clicks",
                "cost_brl": "spend",
                "conversions": "results",
            },
            parse_date=day_month_year,
        ),
        SourceSpec(
            name="tiktok_ads",
            envelope_key="list",
            envelope_extra=("request_id",),
            raw_schema=_schema(
                stat_time="string",
                campaign_title="string",
                ad_group_title="string",
                views="bigint",
                engagements="bigint",
                total_cost="string",
                conversions_count="bigint",
                campaign_objective="string",
                country_code="string",
            ),
            columns={
                "date": "stat_time",
                "campaign_name": "campaign_title",
                "ad_group_name": "ad_group_title",
                "impressions": "views",
                "clicks": "engagements",
                "cost_brl": "total_cost",
                "conversions": "conversions_count",
            },
            parse_date=iso_timestamp_date,
        ),
    )
}


def source_spec(name: str) -> SourceSpec:
    if name not in SOURCES:
        raise KeyError(f"unknown source {name!r}; expected one of {list(SOURCES)}")
    return SOURCES[name]
